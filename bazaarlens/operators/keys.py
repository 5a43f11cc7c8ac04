"""Questions about keys: duplicates, distinct counts, multiplicity, point lookup."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.operators.bitmaps import bitmap_distinct


def duplicate_keys(df: DataFrame, key: str, count_col: str = "count_duplicated") -> DataFrame:
    """Keys that occur more than once, with their count, in key order."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias(count_col))
        .where(F.col(count_col) > 1)
        .orderBy(key)
    )


def distinct_count(
    df: DataFrame, columns: Sequence[str], count_col: str, dense: bool | None = False
) -> DataFrame:
    """Exact number of distinct values, or tuples; a tuple with a null is not counted.

    One integer column whose ids lie close together is better counted by bitmaps:
    ``dense=True``, or None to measure it; see :func:`bitmap_distinct`.
    """
    if dense is not False:
        (column,) = columns
        return bitmap_distinct(df, [], column, count_col, dense)
    return df.agg(F.count_distinct(*[F.col(c) for c in columns]).alias(count_col))


def key_multiplicity(
    df: DataFrame, keys: Sequence[str], sort_by: str, count_col: str = "row_count"
) -> DataFrame:
    """Rows per key tuple, ordered by ``sort_by``.

    The other keys follow in the sort, so that the range partitioning can split a
    ``sort_by`` value shared by very many tuples.
    """
    rest = [k for k in keys if k != sort_by]
    return df.groupBy(*keys).agg(F.count("*").alias(count_col)).orderBy(sort_by, *rest)


def rows_with_key(df: DataFrame, column: str, value: int | str) -> DataFrame:
    """All rows whose ``column`` equals ``value``."""
    return df.where(F.col(column) == F.lit(value))


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows; any ``n`` rows unless ``order_by`` is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def row_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Row count of each named table or view."""
    counts = [
        spark.table(name)
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)
