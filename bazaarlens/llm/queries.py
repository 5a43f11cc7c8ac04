"""The registered queries of the operators, over the tables of one directory."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm import (
    alignment,
    conversations,
    fingerprints,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    personal_data,
    suffix_dedup,
    toxicity,
    url_filter,
    vector_search,
)
from bazaarlens.llm.common import prepare

#: How often the mix may read one source, at most; documents per mixing block in tokens.
REPETITION, BLOCK_TOKENS = 2.0, 1 << 20
#: Fixed values of the URL rules.
URL_RULES = """SELECT * FROM VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block') AS (host, path, verdict)"""
#: Pages of these hosts and their subdomains make the list of blocked URLs.
LISTED_HOSTS = r"(^|\.)(spam-farm|adult-x)\."


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_temperature_mixing(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    counted = docs.select("doc_id", "source", mixing.token_count(F.col("text")).alias("tokens"))
    counted = mixing.checkpointed(counted)
    plan = mixing.weights(counted, repetition=REPETITION)
    return mixing.mixed(counted, plan, block_tokens=BLOCK_TOKENS)


def op2_document_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    return fingerprints.edited_pairs(_table(spark, directory, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, directory: str) -> DataFrame:
    return ngram_join.linked(_table(spark, directory, "documents"), n=4, percent=85)


def op4_nearest_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    return vector_search.nearest(_table(spark, directory, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.packed(_table(spark, directory, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.train(docs, _table(spark, directory, "labels"), ~held_out)
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return toxicity.scored(docs, model, ["doc_id", "held_out"])


def op7_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return line_dedup.without_copies(docs).select(
        "doc_id",
        "lines_deleted",
        F.length(text).cast("long").alias("chars_kept"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"),
    )


def op8_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    kept = suffix_dedup.without_repeats(_table(spark, directory, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_language_id(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language_id.train(language_id.sample(docs, ~held_out))
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return language_id.identified(docs, model, ["doc_id", "held_out"])


def op10_url_filter(spark: SparkSession, directory: str) -> DataFrame:
    pages = _table(spark, directory, "pages").select("page_id", "url")
    listed = pages.where(url_filter.host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return url_filter.filter_urls(pages, listed, spark.sql(URL_RULES)).drop("url")


def op11_conversation_repair(spark: SparkSession, directory: str) -> DataFrame:
    turns = _table(spark, directory, "conversations").select("conv_id", "turn", "role", "text")
    shown = [F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")]
    damage = F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    text = F.when(damage == 1, "").when(damage == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    turns = turns.withColumns({"role": F.when(damage == 4, "user").otherwise(F.col("role")), "text": text})
    return conversations.repaired(turns, F.when(damage == 0, 0).when(damage == 3, 2).otherwise(1))


def op12_cross_tokenizer_alignment(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    return alignment.aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_personal_data(spark: SparkSession, directory: str) -> DataFrame:
    return personal_data.told(personal_data.private_spans(_table(spark, directory, "documents")))


def _prepared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        prepare(spark)
        return query(spark, directory)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _prepared(f)
    for f in (
        op1_temperature_mixing,
        op2_document_fingerprints,
        op3_ngram_jaccard_join,
        op4_nearest_neighbours,
        op5_packing,
        op6_toxicity,
        op7_line_dedup,
        op8_suffix_dedup,
        op9_language_id,
        op10_url_filter,
        op11_conversation_repair,
        op12_cross_tokenizer_alignment,
        op13_personal_data,
    )
}
