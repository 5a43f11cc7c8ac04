"""Whole repeated runs of lines, against brute force."""

import random

import duckdb
import pytest

import corpus_pipeline
from bazaarlens.llm import line_dedup
from bazaarlens.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(texts, least):
    """Lines that lie in a run of so many characters that has occurred before, by definition."""
    where, gone = {}, {k: set() for k in texts}
    split = {k: t.split("\n") for k, t in texts.items()}
    for k in sorted(split):
        for i, line in enumerate(split[k]):
            for other, j in where.get(line, ()):
                n = 0
                while i + n < len(split[k]) and j + n < len(split[other]) and split[k][i + n] == split[other][j + n]:
                    n += 1
                if sum(map(len, split[k][i : i + n])) >= least:
                    gone[k].update(range(i, i + n))
            where.setdefault(line, []).append((k, i))
    return {k: "\n".join(x for i, x in enumerate(split[k]) if i not in gone[k]) for k in split}


def test_a_long_shared_line_followed_by_short_ones(spark):
    shared = ["a" * 54, "b" * 105, "c" * 543, "short end"]
    rows = [(1, "\n".join(["own", *shared])), (2, "\n".join([*shared, "other"])), (3, "\n".join(shared)), (4, "short end")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], SCHEMA)
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert left == {1: rows[0][1], 2: "other", 4: "short end"}


@pytest.mark.parametrize("least", [1, 4, 9])
def test_random_lines(spark, least):
    dice = random.Random(least)
    texts = {i: "\n".join(dice.choice(["", "a", "bb", "ccc", "ddddd"]) for _ in range(dice.randint(1, 14))) for i in range(30)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_copies(docs, least=least).collect()}
    assert got == brute(texts, least)


def test_the_query_deletes_whole_runs(spark, tmp_path):
    shared = ["c" * 54, "b" * 105, "a" * 543, "", "short end"]
    rows = [(1, "\n".join(["own", *shared])), (2, "\n".join([*shared, "other"])), (3, "\n".join(["x", *shared])), (4, "\n".join(shared[2:]))]
    frame = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], SCHEMA)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["lines_deleted"], r["chars_kept"]) for r in QUERIES["op7_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: (0, len(rows[0][1])), 2: (5, 5), 3: (5, 1), 4: (3, 0)}


def test_plans_do_not_grow_with_the_levels(spark):
    """One table of levels: as many exchanges for a run of 2 lines as for one of 300."""
    counts = []
    for n in (2, 300):
        text = "\n".join(f"line {i} of a long run " * 5 for i in range(n))
        gone = line_dedup.deleted_lines(spark.createDataFrame([(1, text), (2, text + "\nx")], "doc_id long, text string"))
        assert gone.count() == n
        counts.append(gone._jdf.queryExecution().executedPlan().toString().count("Exchange"))
    assert counts[0] == counts[1] < 12


def test_whole_runs_of_the_documents(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet' WHERE text IS NOT NULL").fetchall())
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_copies(docs).collect()}
    assert got == brute(texts, line_dedup.LEAST)


def made_rows(plan):
    """Rows out of every explode of an executed plan."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return made_rows(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return made_rows(plan.plan())
    own = plan.metrics().apply("numOutputRows").value() if plan.nodeName() == "Generate" else 0
    return own + sum(made_rows(plan.children().apply(i)) for i in range(plan.children().size()))


def test_a_block_of_blank_lines_is_exploded_once(spark):
    text = "x" * 160 + "\n" * 800 + "y" * 160
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    gone = line_dedup.deleted_lines(docs)
    rows = [(r["doc"]["id"], r["at"]) for r in gone.collect()]
    assert sorted(rows) == [(2, i) for i in range(801)]
    assert made_rows(gone._jdf.queryExecution().executedPlan()) == 801
