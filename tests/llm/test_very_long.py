"""Texts of over two megabytes through every operator."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import (
    fingerprints,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    personal_data,
    suffix_dedup,
    toxicity,
    url_filter,
)


def sentence(seed, n):
    numbers = np.random.default_rng(seed).integers(0, 1 << 40, n)
    return " ".join(f"w{x:x}" for x in numbers)


LONG = sentence(1, 240_000)
PASSAGE = sentence(2, 40)
CUT = (1 << 20) - 100  # across the border of two pieces


@pytest.fixture(scope="module")
def docs(spark):
    """A long text, a near copy of it, one that holds a passage of a short one, and one long word."""
    near = LONG.replace(LONG[5_000:5_011], "zz zz zz", 1)
    held = sentence(3, 230_000)
    held = held[:CUT] + " " + PASSAGE + " " + held[CUT:]
    rows = [(1, LONG), (2, near), (3, held), (4, sentence(4, 9) + " " + PASSAGE), (5, "x" * 2_200_000 + " é end"), (6, LONG)]
    assert min(len(t) for i, t in rows if i != 4) > 2 << 20
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3), dict(rows)


def test_counts_and_mixture(docs):
    frame, texts = docs
    counted = frame.select("doc_id", F.lit("a").alias("source"), mixing.token_count(F.col("text")).alias("tokens"))
    assert {r["doc_id"]: r["tokens"] for r in counted.collect()} == {i: len(t.split()) for i, t in texts.items()}


def test_fingerprints(docs):
    frame, texts = docs
    rows = {r["doc_id"]: r for r in fingerprints.edited_pairs(frame).collect()}
    assert rows[1]["fingerprint"] == rows[6]["fingerprint"] != rows[2]["fingerprint"]
    edited = texts[2][: len(texts[2]) - len(texts[2]) // 2] + texts[1][: len(texts[2]) // 2]
    assert rows[2]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert rows[2]["near_next"] > 0.99 and rows[3]["near_next"] < 0.5


def test_ngram_join(docs):
    frame, texts = docs
    rows = {r["doc_id"]: r for r in ngram_join.linked(frame).collect()}
    assert {i: r["component_id"] for i, r in rows.items()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 1}
    assert rows[3]["n_shingles"] == len(texts[3].split()) - 4 and rows[5]["n_shingles"] == 1


def test_lines(spark):
    lines = [sentence(100 + i, 12) for i in range(16_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["own", *lines[3_000:9_000], "end", *lines[15_990:]])), (3, lines[5] * 14_000)]
    assert len(rows[0][1]) > 2 << 20 and len(rows[2][1]) > 1 << 20
    left = {r["doc_id"]: r["text"] for r in line_dedup.without_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left == {1: rows[0][1], 2: "own\nend", 3: rows[2][1]}


def test_repeats(docs):
    frame, texts = docs
    rows = {r["doc_id"]: r for r in suffix_dedup.without_repeats(frame).collect()}
    assert bytes(rows[1]["kept"]) == bytes(rows[6]["kept"]) == b"" and rows[5]["n_removed"] == 2_200_000
    for i in (3, 4):  # the passage, with the blanks that stand on both sides of both
        kept = texts[i].encode().replace(f" {PASSAGE}".encode() + (b" " if i == 3 else b""), b"", 1)
        assert rows[i]["n_spans"] == 1 and abs(len(rows[i]["kept"]) - len(kept)) <= 2
    changed = [bytes(rows[2]["kept"]), b"zz zz zz"]
    assert changed[1] in changed[0] and len(changed[0]) < 600


def test_language_and_toxicity(docs, spark):
    frame, _ = docs
    taught = spark.createDataFrame([(i, t, x) for i in range(30) for t, x in [("the word is this", "en"), ("das Wort ist dieses", "de")]], "doc_id long, text string, lang string")
    model = language_id.train(language_id.sample(taught, F.lit(True)))
    long = spark.createDataFrame([(1, "this is the word; " * 130_000), (2, "dieses ist das Wort. " * 120_000)], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.identified(long, model).collect()} == {1: "en", 2: "de"}
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 7)], "doc_id long, toxic int")
    scores = toxicity.scored(frame, toxicity.train(frame, labels, F.lit(True)), ["doc_id"])
    assert scores.where("score BETWEEN 0 AND 1").count() == 6


def test_urls(spark):
    path = "/de/" + "a" * 2_100_000
    pages = spark.createDataFrame([(1, f"http://x.com{path}?q"), (2, f"http://x.net{path}/")], "page_id long, url string")
    rules = spark.createDataFrame([("com", "/de/", "block")], "host string, path string, verdict string")
    listed = spark.createDataFrame([(f"http://www.x.net{path}",)], "url string")
    rows = {r["page_id"]: r for r in url_filter.filter_urls(pages, listed, rules).collect()}
    assert (rows[1]["path"], rows[1]["rule"], rows[1]["verdict"]) == (path, "com/de/", "block")
    assert (rows[2]["rule"], rows[2]["verdict"]) == (None, "block")


def test_personal_data(spark):
    text = "a" * 1_100_000 + "@example.org " + LONG[:1_200_000] + " +49 30 123 456 78 or " + "7" * 1_000_000
    rows = personal_data.told(personal_data.private_spans(spark.createDataFrame([(1, text)], "doc_id long, text string"))).collect()
    at = text.index("+49")
    assert rows[0]["spans"] == f"email:0:1100012,phone:{at}:{at + 17}"
