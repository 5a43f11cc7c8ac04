"""Values of a key's rows beside each row, with one shuffle, also where keys are hot.

A window brings all rows of a key to one task, which a key of a third of the rows turns into
the longest task of all. An aggregation joined back does not, but shuffles and reads the rows
more often. So the few hot keys are found first, by a sketch of mergeable counters that needs
no shuffle of rows; their rows meet an aggregation that is broadcast, all others a window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Counters of the sketch; it misses a count by at most some 3.5 / COUNTERS of all rows.
COUNTERS = 10_000
#: The most keys that are taken as hot: what is broadcast has so many rows.
MOST_HOT = 1_000
#: A key is hot with so many shares of rows, one share being the rows of a shuffle partition.
SHARES = 0.5


@dataclass(frozen=True)
class HotKeys:
    """Keys with a large part of the rows, by a hash; another key of the same hash counts as hot.

    ``rows`` is the number of all rows, hot or not.
    """

    columns: tuple[str, ...]
    hashes: tuple[int, ...]
    rows: int = 0

    def match(self) -> Column:
        """Whether a row's key is hot; never null."""
        return _hash(self.columns).isin(list(self.hashes)) if self.hashes else F.lit(False)


def _hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def hot_keys(rows: DataFrame, keys: Sequence[str], shares: float = SHARES) -> HotKeys:
    """The keys that hold more than ``shares`` times the rows of a shuffle partition.

    One pass over the key columns: each task keeps COUNTERS counters, which are merged.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.select(_hash(keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {MOST_HOT}, {COUNTERS})").alias("top"), F.count("*").alias("n")
    ).first()
    least = max(2.0, shares * found["n"] / partitions)
    hashes = tuple(sorted(t["item"] for t in found["top"] or () if t["count"] >= least))
    return HotKeys(tuple(keys), hashes, found["n"])


def with_key_values(
    rows: DataFrame, keys: Sequence[str], values: Mapping[str, Column], hot: HotKeys
) -> DataFrame:
    """The rows with one more column for each of ``values``, an aggregate over the rows of its key.

    Nulls in ``keys`` are equal to one another. ``hot`` may tell hot keys by some of ``keys``
    only; then at most all their keys are aggregated and joined back without a bound that
    allows broadcasting, and adaptive execution chooses the join.
    """
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys])
    if not hot.hashes:
        return rows.withColumns({name: value.over(window) for name, value in values.items()})
    usual = rows.where(~hot.match()).withColumns({name: value.over(window) for name, value in values.items()})
    chosen = rows.where(hot.match())
    groups = chosen.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*[v.alias(n) for n, v in values.items()])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"r.`{k}`").eqNullSafe(F.col(f"g.`{k}`"))
    groups = groups.alias("g")
    joined = chosen.alias("r").join(F.broadcast(groups) if set(hot.columns) == set(keys) else groups, same)
    return usual.unionByName(joined.select("r.*", *[F.col(f"g.`{n}`") for n in values]))
