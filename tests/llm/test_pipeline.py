"""The corpus pipeline against a brute-force version of its stages."""

import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_queries import brute_components
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from bazaarlens.llm.common import written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(seed, n):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 9973}x" for i in range(n))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rows = []
    for i in range(60):
        rows.append((i, sentence(i, 80) + "\n" + sentence(i + 500, 60), "en", "big" if i < 40 else f"s{i % 3}"))
    rows.append((60, rows[3][1], "en", "big"))  # an exact copy
    near = rows[5][1].replace("\n", " ").split(" ")
    rows.append((61, " ".join([*near[:70], "other", *near[71:]]), "en", "s1"))  # a near copy
    rows.append((62, rows[7][1].split("\n")[0] + "\n" + sentence(900, 70), "en", "s2"))  # a shared passage
    rows += [(63, None, "en", "big"), (64, "12 34 !!", "en", "s0"), (65, "", None, None)]
    folder = str(tmp_path_factory.mktemp("planted"))
    frame = spark.createDataFrame([(i, t, a, s, len(t or "")) for i, t, a, s in rows], SCHEMA)
    frame.repartition(4).write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def test_every_stage(spark, planted):
    folder, rows = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, folder))
        assert docs.columns == columns
        left[name] = docs.collect()
    lettered = {i: t for i, t, _, _ in rows if t and re.search("[a-z]", t)}
    assert {r["doc_id"] for r in left["language"]} == set(lettered)
    # 60 loses both lines, 62 the first
    lines = {r["doc_id"]: r for r in left["lines"]}
    assert set(lines) == set(lettered) - {60}
    assert lines[62]["text"] == sentence(900, 70) and lines[62]["n_chars"] == len(lines[62]["text"])
    assert all(lines[i]["text"] == lettered[i] for i in lines if i != 62)
    parts = brute_components({i: r["text"] for i, r in lines.items()}, 5, 80)
    kept = {i for i in parts if parts[i][1] == i}
    assert {r["doc_id"] for r in left["near_duplicates"]} == kept and 61 not in kept and 5 in kept
    copies = Counter(r["doc_id"] for r in left["mixture"])
    assert set(copies) == kept and set(copies.values()) <= {1, 2}
    assert all(copies[r["doc_id"]] == 1 for r in left["mixture"] if r["source"] == "big")
    pieces = corpus_pipeline.run(spark, folder).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    tokens = sum(
        n * (len(tokenizer.encode(lines[i]["text"], add_special_tokens=False).ids) + 1) for i, n in copies.items()
    )
    assert sum(r["length"] for r in pieces) == tokens
    assert Counter(r["doc_id"] for r in pieces if r["start"] == 0) == copies


def test_an_empty_table_passes(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_are_registered():
    names = driver.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def test_one_row_of_each_group_stays(spark):
    """Repeated and null ids: a clean text that shares an id stays, of equal rows one stays."""
    x, near = sentence(1, 90), " ".join([*sentence(1, 90).split(" ")[:80], "other", *sentence(1, 90).split(" ")[81:]])
    other, more = sentence(2, 90), sentence(3, 90)
    rows = [
        (1, x), (2, near), (2, other), (1, x), (None, x), (None, other), (None, more), (None, more), (5, more),
        (3, None), (3, None), (4, ""), (7, "one word"), (7, "one word"), (None, "one word"), (2, near),
    ]
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", len(t or "")) for k, (i, t) in enumerate(rows)], SCHEMA)
    docs = docs.withColumn("component", F.lit(1)).withColumn("its id", F.lit(2)).repartition(4)
    left = corpus_pipeline.near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in left.collect()]
    want = [(1, x), (2, other), (5, more), (3, None), (3, None), (4, ""), (7, "one word")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_the_first_stages_with_clashing_columns(spark):
    text = sentence(1, 50)
    docs = spark.createDataFrame([(i, sentence(i, 50), "en", "a", 1) for i in range(30)] + [(40, text, "en", None, 2)], SCHEMA)
    for name in ("lang_pred", "score", "rejected", "gone", "lines_deleted", "lines gone", "mark", "often", "own id", "block"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, ""))
    assert {tuple(r[len(SCHEMA.split(",")) :]) for r in docs.collect()} == {tuple(f"own {x}" for x in docs.columns[5:])}
    assert {r["doc_id"] for r in docs.collect()} == set(range(30))
    pieces = corpus_pipeline.pack(spark, docs, "").collect()
    assert {r["doc_id"] for r in pieces} == set(range(30))
