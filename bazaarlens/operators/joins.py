"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join rows back to an aggregation of them, so that a hot key can be split.

    Nulls in ``keys`` match nulls. Result columns: those of ``rows``, then those of
    ``groups`` that are not keys.

    Adaptive execution splits a skewed partition if the join reads both sides straight
    from a shuffle. After ``groupBy(keys)`` a plain equi join on ``keys`` does not: it
    keeps the partitioning of the aggregation, and all rows of a key meet in one task.
    The null-safe comparison shuffles the groups once more, and hot keys are split. (Two
    sides that are declared NOT NULL lose this: there Spark plans the plain equi join.)
    """
    match = [F.col(f"r.`{k}`").eqNullSafe(F.col(f"g.`{k}`")) for k in keys]
    joined = rows.alias("r").join(groups.alias("g"), reduce(and_, match), how)
    return joined.select(
        "r.*", *[F.col(f"g.`{c}`") for c in groups.columns if c not in keys]
    )


def join_lookup(rows: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """LEFT JOIN many rows to a lookup with few keys, such as one row per region.

    No hint is given: adaptive execution broadcasts the lookup if its measured size allows,
    and otherwise splits a hot key. For the split both sides must be shuffled for this join,
    also a lookup that is grouped by the keys; the null-safe comparison sees to that, as in
    :func:`join_groups`. A null key matches nothing.
    """
    known = lookup.where(reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys]))
    match = [F.col(f"r.`{k}`").eqNullSafe(F.col(f"l.`{k}`")) for k in keys]
    joined = rows.alias("r").join(known.alias("l"), reduce(and_, match), "left")
    return joined.select(
        "r.*", *[F.col(f"l.`{c}`") for c in lookup.columns if c not in keys]
    )
