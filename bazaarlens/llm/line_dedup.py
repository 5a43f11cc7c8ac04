"""Deletes later copies of repeated runs of lines.

A document is a sequence of lines, the pieces between line feeds. Over the concatenated
sequences of line IDs (two 64-bit hashes of a line) the suffixes are named by prefix
doubling: two suffixes have one name at level j when their first 2^j lines are equal, and
the name at level j + 1 is made of the names of both halves. Suffixes whose name is unique
at a level leave: their common prefix with every other is shorter. What stays at a level is
the set of intervals of the suffix array with a longest common prefix of 2^j lines or more.

The levels are one table. A maximal repeated run of `least` characters or more is the union of the
shortest runs of so many characters that start, or end, at its lines: where so many fit in the run
from a line, or up to it, that shortest run lies inside; where neither is so, the line lies in the
shortest run from the first line. So these are looked up, each by two names of the level of its
number of lines, which cover it. A line goes when such a run that contains it has occurred before,
in the order of doc_id and line, so later copies of maximal runs go whole. Copies inside one document
count. This is the rule of the SQL of op7_line_dedup, which compares the maximal runs themselves.

Only lines that occur twice are ever shuffled beyond the first count; the work of the later
levels follows the repeated text. Names are counted with sums combined before the shuffle.
They join back by null-safe equality, which shuffles both sides for the join instead of using
the counts' partitioning, so that adaptive execution can split a line of a third of all
documents.

Edge cases: a null text stays null, and an empty one empty. A document of which all lines go
is left with an empty text. Rows that share a doc_id are different documents if their texts
differ, and otherwise one document, so that both stay. A null doc_id comes after all others.
A very long text is a row for each of its lines, and hashed line by line. An empty table gives no
rows. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import free_name, shared_folder, written

#: Characters that a repeated run must have; line feeds do not count.
LEAST = 150


def _name(*parts: Column | str) -> Column:
    return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2"))


def lines(docs: DataFrame) -> DataFrame:
    """One row a line: doc (identity of the document), at, name, size."""
    split = docs.where("text IS NOT NULL").select(
        document(docs).alias("doc"), F.posexplode(F.split("text", "\n")).alias("at", "line")
    )
    return split.select("doc", "at", _name("line").alias("name"), F.length("line").alias("size"))


def document(docs: DataFrame) -> Column:
    """Sorts as doc_id does, nulls last; texts that share one are told apart by a hash."""
    return F.struct(
        F.col("doc_id").isNull().alias("unknown"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64("text").alias("text"),
    )


def _repeated(named: DataFrame) -> DataFrame:
    """The rows whose name occurs more than once."""
    often = named.groupBy("name").agg(F.count("*").alias("often")).where("often > 1")
    return named.join(often, named["name"].eqNullSafe(often["name"]), "left_semi")


def levels(all_lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc, at, name and size of the lines that occur twice; and level, doc, at, name of the 2^level
    lines from there, where those occur twice."""
    base = written(_repeated(all_lines).distinct())  # equal rows are one document
    spark, folder = all_lines.sparkSession, shared_folder(all_lines.sparkSession)
    now, level = base.select("doc", "at", "name"), 0
    schema = now.schema
    while True:
        now.write.option("compression", "zstd").parquet(f"{folder}/level={level}")
        now = spark.read.schema(schema).parquet(f"{folder}/level={level}")
        if now.isEmpty():
            break
        later = now.select("doc", (F.col("at") - (1 << level)).alias("at"), F.col("name").alias("next"))
        now = _repeated(now.join(later, ["doc", "at"]).select("doc", "at", _name("name", "next").alias("name")))
        level += 1
    return base, spark.read.schema(schema.add("level", "integer")).option("basePath", folder).parquet(folder)


def _shortest(stretch: DataFrame, least: int) -> DataFrame:
    """doc, at and m (lines) of the shortest runs of `least` characters from and up to each line."""
    before = F.col("upto") - F.col("size")
    rows = lambda ask, value: stretch.select("doc", "stretch", "at", F.lit(ask).alias("ask"), value.alias("value"))
    window = Window.partitionBy("doc", "stretch").rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(F.col("ask") == 0, F.col("at"))
    # such a run from a line ends at the first line where the characters up to there exceed those
    # before the line by so many; in falling order every mark at or above an asked value comes first
    ahead = rows(0, F.col("upto")).union(rows(1, before + F.lit(least)))
    ahead = ahead.withColumn("end", F.min(mark).over(window.orderBy(F.desc("value"), "ask")))
    ahead = ahead.where("ask = 1 AND end >= at").select("doc", "at", (F.col("end") - F.col("at") + 1).alias("m"))
    # one up to a line starts at the last line before which they are fewer by so many than those
    # up to the line; in rising order every mark at or below an asked value comes first
    back = rows(0, before).union(rows(1, F.col("upto") - F.lit(least)))
    back = back.withColumn("start", F.max(mark).over(window.orderBy("value", "ask")))
    back = back.where("ask = 1 AND start <= at").select("doc", F.col("start").alias("at"), (F.col("at") - F.col("start") + 1).alias("m"))
    return ahead.union(back).distinct()


def deleted_lines(docs: DataFrame, *, least: int = LEAST) -> DataFrame:
    """doc and at of every line that goes."""
    base, names = levels(lines(docs))
    # stretches of neighbouring repeated lines; a run lies inside one
    in_doc = Window.partitionBy("doc").orderBy("at")
    stretch = base.withColumn("stretch", F.col("at") - F.row_number().over(in_doc))
    so_far = Window.partitionBy("doc", "stretch").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    stretch = written(stretch.select("doc", "at", "size", "stretch", F.sum("size").over(so_far).cast("long").alias("upto")))
    runs = _shortest(stretch, least).withColumn("level", F.length(F.bin("m")) - 1)
    runs = runs.withColumn("tail", F.expr("at + m - shiftleft(1, level)"))
    at_start = names.select("level", "doc", "at", F.col("name").alias("first"))
    at_end = names.select("level", "doc", F.col("at").alias("tail"), F.col("name").alias("last"))
    named = runs.join(at_start, ["level", "doc", "at"]).join(at_end, ["level", "doc", "tail"])
    named = written(named.select("doc", "at", "m", _name("m", "first", "last").alias("name")))
    place = F.struct("doc", "at")
    first = named.groupBy("name").agg(F.min(place).alias("first"), F.count("*").alias("often")).where("often > 1")
    first = first.select(F.col("name").alias("same"), "first")
    copies = named.join(first, F.col("name").eqNullSafe(F.col("same"))).where(place > F.col("first"))
    # of each run only the lines after all earlier runs of the document
    until = F.col("at") + F.col("m") - 1
    earlier = Window.partitionBy("doc").orderBy("at", "m").rowsBetween(Window.unboundedPreceding, -1)
    copies = copies.select("doc", "at", until.alias("until"), F.max(until).over(earlier).alias("done"))
    copies = copies.select("doc", F.greatest("at", F.col("done") + 1).alias("at"), "until").where("at <= until")
    return copies.select("doc", F.explode(F.sequence("at", "until")).alias("at"))


def without_copies(docs: DataFrame, *, least: int = LEAST) -> DataFrame:
    """The documents with their columns, text without the deleted lines, and lines_deleted."""
    gone = deleted_lines(docs, least=least).groupBy("doc").agg(F.collect_set("at").alias("lines"))
    kept = [c for c in docs.columns if c.lower() != "lines_deleted"]
    its, lost = free_name("its document", docs), free_name("lines gone", docs)
    joined = docs.select(*[docs[c] for c in kept], document(docs).alias(its)).join(gone.toDF(its, lost), its, "left")
    schema = docs.select(*kept).schema
    place = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = batch.column(place).to_pylist(), batch.column(len(kept)).to_pylist()
            for i, lost in enumerate(gone):
                if lost:
                    lost = set(lost)
                    texts[i] = "\n".join(x for at, x in enumerate(texts[i].split("\n")) if at not in lost)
            columns = [*batch.columns[:place], pa.array(texts, pa.string()), *batch.columns[place + 1 : len(kept)]]
            counts = pa.array([len(x or ()) for x in gone], pa.int32())
            yield pa.RecordBatch.from_arrays([*columns, counts], [*kept, "lines_deleted"])

    return joined.select(*kept, lost).mapInArrow(run, schema.add("lines_deleted", "integer"))
