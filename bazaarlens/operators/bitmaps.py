"""Exact distinct counts of integer ids by bitmaps.

A bucket of ids is a bitmap of 4 KB that stands for 32,768 of them; bitmaps are combined in
each task before they are shuffled. Where ids lie close together this moves a small part of
what distinct pairs of group and id do. Where they do not, a bitmap would hold few ids, so
buckets that are thinly filled are counted by their distinct ids instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a bitmap, and of an id in a shuffle, about.
BITMAP_BYTES, PAIR_BYTES = 4096, 16
_BUCKET, _POSITION, _IDS, _DENSE = "__bucket", "__position", "__ids", "__dense"


def bitmap_distinct(
    df: DataFrame, by: Sequence[str], column: str, count_col: str, dense: bool | None = None
) -> DataFrame:
    """Exact number of distinct non-null ids for each value of ``by``, or of all rows.

    ``dense`` tells whether ids lie close together: if so all go by bitmaps, if not none. If
    it is None that is measured bucket by bucket, in one more pass over the ids that shuffles
    a number a bucket. The result is the same in any case: ids of one bucket go one way.
    """
    groups = [F.col(f"`{c}`") for c in by]
    ids = df.select(*groups, F.col(f"`{column}`").cast("bigint").alias(_IDS))
    ids = ids.withColumn(_BUCKET, F.bitmap_bucket_number(_IDS)).withColumn(_POSITION, F.bitmap_bit_position(_IDS))
    if dense is None:
        counted = _told(ids, groups)
        parts = [_by_bitmap(counted.where(_DENSE), groups), _by_id(counted.where(f"NOT {_DENSE}"), groups)]
        counts = parts[0].unionByName(parts[1])
    else:
        counts = _by_bitmap(ids, groups) if dense else _by_id(ids, groups)
    return counts.groupBy(*groups).agg(F.coalesce(F.sum(_IDS), F.lit(0)).alias(count_col))


def _by_bitmap(ids: DataFrame, groups: list[Column]) -> DataFrame:
    """A null id has no bucket and sets no bit, so its group keeps a row."""
    bitmaps = ids.groupBy(*groups, _BUCKET).agg(F.bitmap_construct_agg(_POSITION).alias("bits"))
    return bitmaps.select(*groups, F.bitmap_count("bits").alias(_IDS))


def _by_id(ids: DataFrame, groups: list[Column]) -> DataFrame:
    """Grouped by the pair as one value, so that rows which arrive by group are spread again."""
    pairs = ids.select(F.struct(*groups, _IDS).alias("pair")).distinct().select("pair.*")
    return pairs.groupBy(*groups).agg(F.count(_IDS).alias(_IDS))


def _told(ids: DataFrame, groups: list[Column]) -> DataFrame:
    """The ids with whether their bucket is dense: in a task a bitmap is smaller than its ids.

    A dense bucket has 256 rows a task, so there are no more of them than a task has rows / 256,
    which is what is broadcast.
    """
    tasks = max(1, ids.rdd.getNumPartitions())
    least = tasks * BITMAP_BYTES // PAIR_BYTES
    names = [c for c in ids.columns if c not in (_IDS, _BUCKET, _POSITION)]
    filled = ids.groupBy(*groups, _BUCKET).agg((F.count("*") >= least).alias(_DENSE)).where(_DENSE)
    same = F.col(f"i.{_BUCKET}").eqNullSafe(F.col(f"f.{_BUCKET}"))
    for c in names:
        same = same & F.col(f"i.`{c}`").eqNullSafe(F.col(f"f.`{c}`"))
    joined = ids.alias("i").join(F.broadcast(filled.alias("f")), same, "left")
    return joined.select("i.*", F.coalesce(F.col(f"f.{_DENSE}"), F.lit(False)).alias(_DENSE))
