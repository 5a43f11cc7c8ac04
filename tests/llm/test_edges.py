"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import (
    fingerprints,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    suffix_dedup,
    toxicity,
    url_filter,
    vector_search,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def words(n, step=1):
    return " ".join(WORDS[(i * i * step + i) % len(WORDS)] + str(i * step % 89) for i in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Every odd case, with columns that clash with what operators return."""
    same = words(120)
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "de", None, 4),
        (4, same, "en", "a", len(same)),
        (4, same, "en", "a", len(same)),
        (5, same, None, "b", None),
        (None, same + "\nand more", "en", None, 3),
        (6, "§ 12 — 34", "fr", "b", 9),
        (7, words(60_000, 7), "en", "b", None),
        (8, "one", None, "b", 3),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("score", "key", "range", "doc", "gone", "spans", "row", "component", "of", "epoch", "tokens", "text to keep"):
        frame = frame.withColumn(name, F.lit(f"own {name}"))
    return frame.repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(frame):
    return [(r["doc_id"], r["text"] or "") for r in frame.collect()]


def test_mixing(odd, empty):
    counted = lambda docs: docs.select("doc_id", "source", mixing.token_count(F.col("text")).alias("tokens"))
    plan = mixing.weights(counted(odd), repetition=3.0)
    assert {r["source"] for r in plan.collect()} == {"a", "b", None}
    draws = mixing.mixed(counted(odd), plan, block_tokens=64)
    assert draws.where("epoch = 1").count() == 10
    again = mixing.resampled(odd, repetition=3.0)
    assert again.columns == odd.columns
    assert again.count() >= draws.count()
    none = mixing.weights(counted(empty), repetition=2.0)
    assert mixing.mixed(counted(empty), none, block_tokens=64).count() == 0
    assert mixing.resampled(empty, entropy=1.0).count() == 0


def test_mixing_meets_its_targets(spark):
    rows = [(i, "big" if i % 3 else f"small {i % 4}", 100 + i % 7) for i in range(3000)]
    counted = spark.createDataFrame(rows, "doc_id long, source string, tokens long")
    limit = mixing.weights(counted, repetition=1.7)
    assert abs(limit.agg(F.max("repetition")).first()[0] - 1.7) < 1e-3
    assert limit.agg(F.min("repetition")).first()[0] == 1.0
    aim = mixing.weights(counted, entropy=1.2).collect()
    assert abs(-sum(r["weight"] * math.log(r["weight"]) for r in aim) - 1.2) < 1e-6
    budget = mixing.weights(counted, repetition=1.5, budget=100_000)
    draws = mixing.mixed(counted, budget, block_tokens=10_000)
    want = {r["source"]: r["budget"] for r in budget.collect()}
    drawn = {r["source"]: r["n"] for r in draws.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
    assert all(0 <= drawn[s] - want[s] < 107 for s in want)
    # every block holds the sources in the target weights
    shares = draws.groupBy("block").agg((F.sum(F.when(F.col("source") == "big", F.col("tokens"))) / F.sum("tokens")).alias("x"))
    weight = want["big"] / sum(want.values())
    assert all(abs(r["x"] - weight) < 0.05 for r in shares.collect())


def test_fingerprints(odd, empty):
    docs = texts_of(odd)
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1]))
    rows = fingerprints.edited_pairs(odd).collect()
    want = []
    for i, (doc_id, text) in enumerate(order):
        half, following = len(text) // 2, order[(i + 1) % len(order)][1]
        edited = text[: len(text) - half] + following[:half]
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    key = lambda r: repr(r)
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=key) == sorted(want, key=key)
    assert fingerprints.edited_pairs(empty).count() == 0
    alone = odd.where("doc_id = 8")
    assert fingerprints.edited_pairs(alone).first()["near_next"] == 1.0
    assert fingerprints.fingerprints(odd).count() == 10 and fingerprints.fingerprints(empty).count() == 0


def test_ngram_join(odd, empty):
    rows = ngram_join.linked(odd, n=4, percent=85).collect()
    assert len(rows) == 10
    of = {(r["doc_id"], r["n_shingles"] > 0): r["component_id"] for r in rows}
    assert (of[4, True], of[5, True], of[None, True], of[7, True], of[8, True]) == (4, 4, 4, 7, 8)
    assert of[1, False] == 1 and of[2, False] == 2 and of[3, False] == 3
    assert ngram_join.linked(empty).count() == 0


def test_common_grams_change_nothing(spark):
    base = words(200).split()
    rows = [(i, " ".join(w if (j * 7 + i) % (40 + i % 9) else f"x{i}" for j, w in enumerate(base))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    told = [
        sorted(map(tuple, ngram_join.linked(docs, n=3, percent=80, common=x).collect())) for x in (2, 10, 1000)
    ]
    assert told[0] == told[1] == told[2]
    assert 1 < len({r[2] for r in told[0]}) < 60


def test_line_dedup(odd, empty):
    rows = line_dedup.without_copies(odd).collect()
    assert len(rows) == 10
    left = {(r["doc_id"], r["text"], r["lines_deleted"]) for r in rows}
    same = words(120)
    assert (1, None, 0) in left and (2, "", 0) in left
    # equal rows are one document, and the first copy stays
    assert sum(r["doc_id"] == 4 and r["text"] == same for r in rows) == 2
    assert (5, "", 1) in left and (None, "and more", 1) in left
    assert line_dedup.without_copies(empty).count() == 0


@pytest.mark.parametrize("common", [2, 3, 128])
def test_suffix_dedup(spark, odd, empty, common):
    passage = words(70, 3)
    rows = [(100 + i, f"{words(40, i + 5)} {passage[i % 4 :]} {words(30, 200 + i % 9)}") for i in range(25)]
    some = odd.select("doc_id", "text").where("doc_id <> 7 OR doc_id IS NULL")
    odd = some.union(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    rows = suffix_dedup.without_repeats(odd, common=common).collect()
    docs = texts_of(odd)
    raw = [t.encode() for _, t in docs]
    starts = {}
    for text in raw:
        for i in range(len(text) - 199):
            starts[text[i : i + 200]] = starts.get(text[i : i + 200], 0) + 1
    want = []
    for (doc_id, _), text in zip(docs, raw):
        lost = set()
        for i in range(len(text) - 199):
            if starts[text[i : i + 200]] > 1:
                lost.update(range(i, i + 200))
        want.append((doc_id, len(text), len(lost), bytes(b for i, b in enumerate(text) if i not in lost)))
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_packing(odd, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.packed(odd, path).collect()
    starts = [r for r in rows if r["start"] == 0]
    assert len(starts) == 10
    assert sum(r["length"] for r in rows) == sum(r["doc_tokens"] for r in starts)
    assert {r["doc_tokens"] for r in starts if r["doc_id"] in (1, 2, 3)} == {1}
    assert packing.packed(empty, path).count() == 0


def test_toxicity(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1), (4, 0), (7, 0), (8, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels, F.lit(True))
    rows = toxicity.scored(odd, model, ["doc_id"]).collect()
    assert len(rows) == 10 and len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    none = toxicity.train(odd, labels.limit(0), F.lit(True))
    assert {r["predicted"] for r in toxicity.scored(odd, none, ["doc_id"]).collect()} == {0}
    assert toxicity.scored(empty, toxicity.train(empty, labels, F.lit(True)), ["doc_id"]).count() == 0


def test_language(odd, empty):
    model = language_id.train(language_id.sample(odd, F.lit(True)))
    rows = language_id.identified(odd, model).collect()
    assert len(rows) == 10
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 6)} == {"und"}
    assert all(r["rejected"] and r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    nothing = language_id.train(language_id.sample(empty, F.lit(True)))
    assert {r["lang_pred"] for r in language_id.identified(odd, nothing, ["doc_id"]).collect()} == {"und"}
    assert language_id.identified(empty, model).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (50, [0.0, 2.0]), (1, [3.0, 0.0]), (2, [3.0, 0.0]), (2, [3.0, 0.0]), (3, None),
        (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [inf, 1.0]), (8, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]),
        (100, []), (9, [1e-200, 1e-200]),
    ]
    vectors = spark.createDataFrame([(i, v, "own") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = vector_search.nearest(vectors, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    found = {q: [r["vec_id"] for r in got if r["query_id"] == q] for q in (0, 50, 100)}
    assert found == {0: [1, 2, 9, 50], 50: [9, 0, 1, 2], 100: []}
    assert vector_search.nearest(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1?x#y", "http://example.org", "http://org/x",
        "http://myorg/x", "x://b.com/fr/#/", "http://listed.net/p/?q", "http://www.listed.net/p", "http://listed.net/q",
    ]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)] * 2, "page_id long, url string, verdict string")
    rules = spark.createDataFrame(
        [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow"), (None, "/", "block"), ("org", "/", "allow")],
        "host string, path string, verdict string",
    )
    listed = spark.createDataFrame([("http://listed.net/p",), ("http://listed.net/p/",), (None,), ("junk",)], "url string")
    rows = url_filter.filter_urls(pages, listed, rules).collect()
    assert len(rows) == 2 * len(urls)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert [got[i] for i in range(4)] == [("", "", None, "allow")] * 4
    assert got[4] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[5] == ("example.org", "", None, "allow")
    assert got[6] == ("org", "/x", "org/", "allow")
    assert got[7] == ("myorg", "/x", None, "allow")
    assert got[8] == ("b.com", "/fr/", "com/fr/", "allow")
    assert [got[i][3] for i in (9, 10, 11)] == ["block", "block", "allow"]
    assert url_filter.filter_urls(pages.limit(0), listed, rules).count() == 0
    bare = url_filter.filter_urls(pages, listed.limit(0), rules.limit(0))
    assert {r["verdict"] for r in bare.collect()} == {"allow"}
