"""Models whose order total passes its own 30% threshold.

A model (region, item, model) has one threshold: 30% of its order total, rounded
half-even to a whole number. Its rows in the join with the platform lookup, one per
lookup row of its region, are ranked by their share of the platform's orders, and the
ranks up to the threshold are kept. So a model passes if its threshold is 1 or more.
``text_threshold`` asks for the threshold's text to be compared as it stands: see
:func:`bazaarlens.functions.last_admitted_rank`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.numbers import (
    fixed_text,
    last_admitted_rank,
    ratio,
    threshold_text,
)
from bazaarlens.operators.bitmaps import bitmap_distinct
from bazaarlens.operators.hot import HotKeys, with_key_values
from bazaarlens.operators.joins import join_groups, join_lookup
from bazaarlens.operators.pricing import PricingColumns

SHARE = 0.3
FLAG = "is_top_30_model"
_RATIO_DIGITS = 10
_MOST_RANKS = 2**31 - 1
_COPIES, _LISTINGS, _SUM = "__copies", "__listings", "__sum"


def top30_ranked_models(
    pricing: DataFrame,
    platform: DataFrame,
    columns: PricingColumns = PricingColumns(),
    share: float = SHARE,
    text_threshold: bool = False,
    descending: bool = True,
) -> DataFrame:
    """The kept rows, with order total, platform total, share, threshold and rank.

    The share is ranked as the ten-decimal text it is shown as, highest first unless
    ``descending`` is off; the platform total breaks ties. The lookup rows of its region are
    ranked within the row of a model: no row but the kept ones is made, and no task sorts them.
    """
    admitted = _last_rank(share, text_threshold)
    total = columns.platform_order
    listings = platform.groupBy(columns.region).agg(F.collect_list(F.struct(total)).alias(_LISTINGS))
    models = join_lookup(_order_sums(pricing, columns).where(admitted >= 1), listings, [columns.region])
    # a region that the lookup lacks has one rank, without a platform total
    unlisted = F.array(F.struct(F.lit(None).cast(platform.schema[total].dataType).alias(total)))
    shares = F.transform(
        F.coalesce(_LISTINGS, unlisted),
        lambda listed: F.struct(
            fixed_text(ratio(F.col("sum_units"), listed[total]), _RATIO_DIGITS).alias("contribute_ratio"),
            listed[total].alias(total),
        ),
    )
    # nulls come first in ascending order and last in descending order
    kept = F.slice(F.sort_array(shares, asc=not descending), 1, F.least(admitted, F.lit(_MOST_RANKS)).cast("int"))
    return models.select(
        *columns.model_key,
        "sum_units",
        threshold_text(F.col("sum_units"), share).alias("order_threshold"),
        F.posexplode(kept).alias("rank", "listed"),
    ).select(
        *columns.model_key,
        "sum_units",
        F.col("listed")[total].alias(total),
        F.col("listed")["contribute_ratio"].alias("contribute_ratio"),
        "order_threshold",
        (F.col("rank") + 1).alias("contribution_rank"),
    )


def top30_item_count(
    pricing: DataFrame,
    columns: PricingColumns = PricingColumns(),
    share: float = SHARE,
    text_threshold: bool = False,
    dense_items: bool | None = False,
) -> DataFrame:
    """Distinct items per region with a model that passes.

    Rank 1 always exists, whatever the lookup holds, so neither the lookup nor the
    ranking is needed. ``dense_items`` tells whether item ids lie close together, None if that
    is to be measured: then the items are counted by bitmaps, see :func:`bitmap_distinct`.
    """
    passing = _order_sums(pricing, columns).where(_last_rank(share, text_threshold) >= 1)
    if dense_items is not False:
        return bitmap_distinct(passing, [columns.region], columns.item, "number_of_item_tops_30", dense_items)
    return (
        passing.groupBy(columns.region)
        .agg(F.count_distinct(columns.item).alias("number_of_item_tops_30"))
    )


def top30_model_flag(
    pricing: DataFrame,
    platform: DataFrame | None = None,
    columns: PricingColumns = PricingColumns(),
    share: float = SHARE,
    text_threshold: bool = False,
    drop: Sequence[str] = ("_c0",),
    hot: HotKeys | None = None,
) -> DataFrame:
    """Every pricing row with ``is_top_30_model`` 1 or 0; ``drop`` names index columns.

    A row whose region the lookup lists n times appears once per kept rank, up to n
    times; ``platform`` is needed only if a region can repeat in it. Rows with a null in
    (region, item, model) are never flagged. A flag column the table has already is
    replaced. With ``hot``, the hot models by some of these columns, rows get their model's
    total by one shuffle; without, by an aggregation joined back, which needs no such list.
    """
    key = columns.model_key
    if hot is not None:
        return _flagged_by_window(pricing.drop(*drop, FLAG), platform, columns, share, text_threshold, hot)
    admitted = _last_rank(share, text_threshold)
    passing = (
        _order_sums(pricing.where(_whole_key(key)), columns)
        .where(admitted >= 1)
        .select(*key, admitted.alias(_COPIES))
    )
    if platform is None:
        passing = passing.withColumn(_COPIES, F.lit(1))
    else:
        listings = platform.groupBy(columns.region).agg(F.count("*").alias(_LISTINGS))
        passing = join_lookup(passing, listings, [columns.region]).select(
            *key, F.least(_COPIES, F.coalesce(_LISTINGS, F.lit(1))).cast("int").alias(_COPIES)
        )

    flagged = join_groups(pricing.drop(*drop, FLAG), passing, key, "left")
    others = [c for c in flagged.columns if c not in key and c != _COPIES]
    flag = F.col(_COPIES).isNotNull().cast("int")
    if platform is None:
        return flagged.select(*key, *others, flag.alias(FLAG))
    each_copy = F.explode(F.array_repeat(flag, F.coalesce(_COPIES, F.lit(1))))
    return flagged.select(*key, *others, each_copy.alias(FLAG))


def _flagged_by_window(
    rows: DataFrame,
    platform: DataFrame | None,
    columns: PricingColumns,
    share: float,
    text_threshold: bool,
    hot: HotKeys,
) -> DataFrame:
    key = columns.model_key
    others = [c for c in rows.columns if c not in key]
    summed = with_key_values(rows, key, {_SUM: F.sum(columns.units)}, hot)
    admitted = last_admitted_rank(F.col(_SUM), share, text_threshold)
    passes = F.coalesce(_whole_key(key) & (admitted >= 1), F.lit(False))
    if platform is None:
        return summed.select(*key, *others, passes.cast("int").alias(FLAG))
    listings = platform.groupBy(columns.region).agg(F.count("*").alias(_LISTINGS))
    listed = join_lookup(summed, listings, [columns.region])
    copies = F.when(passes, F.least(admitted, F.coalesce(_LISTINGS, F.lit(1)))).otherwise(F.lit(1))
    each_copy = F.explode(F.array_repeat(passes.cast("int"), copies.cast("int")))
    return listed.select(*key, *others, each_copy.alias(FLAG))


def _order_sums(pricing: DataFrame, columns: PricingColumns) -> DataFrame:
    return pricing.groupBy(*columns.model_key).agg(F.sum(columns.units).alias("sum_units"))


def _whole_key(key: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in key])


def _last_rank(share: float, text_threshold: bool) -> Column:
    return last_admitted_rank(F.col("sum_units"), share, text_threshold)
