"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Between stages the rows are written as Parquet and read again.

1. language: documents without a recognised language go.
2. lines: later copies of repeated runs of lines go; a document that loses all lines goes.
3. near duplicates: of documents linked by n-gram overlap, one row of the smallest doc_id stays;
   null ids come last. Rows are told apart by doc_id and text, so a text that shares its doc_id
   with a copy stays, and of equal rows one.
4. mixture: every document is read at least once; documents of small sources are read more
   often, up to a limit, and then stand in several rows.
5. packing: the pieces of the token sequences.

Any column may be null, and tables may be empty: see the operators. Columns beyond those of
documents pass the first four stages unchanged, except n_chars, which follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm import language_id, line_dedup, mixing, ngram_join, packing
from bazaarlens.llm.common import prepare, written

#: Words and percent of the near-duplicate stage; how often the mixture may read one source.
SHINGLE, PERCENT, REPETITION = 5, 80, 2.0
TOKENIZER = "word_bpe_49k.json"


def _aside(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the other columns as one, so that no operator meets their names."""
    return docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("others"))


def _back(frame: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    found = {c: F.col("text") if c == "text" else F.col("others").getField(c) for c in columns} | changed
    return frame.select(*[found[c].alias(c) for c in columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = language_id.train(language_id.sample(docs, F.lit(True)))
    told = language_id.identified(_aside(docs), model)
    return _back(told.where(~F.col("rejected")), docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    kept = line_dedup.without_copies(_aside(docs)).where("lines_deleted = 0 OR text <> ''")
    n_chars = F.when(F.col("lines_deleted") > 0, F.length("text")).otherwise(F.col("others.n_chars")).cast("long")
    return _back(kept, docs.columns, n_chars=n_chars)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.without_copies(docs, n=SHINGLE, percent=PERCENT)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resampled(docs, repetition=REPETITION)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", pack),
]

#: SQL expresses neither the language model nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
