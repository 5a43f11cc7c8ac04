"""How large a part of a category's orders each item appears in.

Expected columns, all renamable by keyword: ``order_items(order_id, item_id,
create_timestamp)`` and ``item_category(item_id, cluster)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.dates import Day, day_of, within_days
from bazaarlens.functions.numbers import ratio
from bazaarlens.operators.bitmaps import bitmap_distinct
from bazaarlens.operators.joins import join_lookup


def categorised_orders(
    order_items: DataFrame,
    item_category: DataFrame,
    first_day: Day,
    last_day: Day,
    order: str = "order_id",
    item: str = "item_id",
    order_time: str = "create_timestamp",
    cluster: str = "cluster",
) -> DataFrame:
    """Order rows of the window with their category; null where the item has none."""
    return (
        order_items.where(within_days(order_time, first_day, last_day))
        .select(order, item, day_of(order_time).alias("create_date"))
        .join(item_category.select(item, cluster), item, "left")
        .select(order, item, "create_date", cluster)
    )


def category_contribution(
    order_items: DataFrame,
    item_category: DataFrame,
    first_day: Day,
    last_day: Day,
    min_rate: float = 0.5,
    inclusive: bool = False,
    order: str = "order_id",
    item: str = "item_id",
    order_time: str = "create_timestamp",
    cluster: str = "cluster",
    dense_orders: bool | None = False,
) -> DataFrame:
    """Items present in more than ``min_rate`` of their category's distinct orders.

    ``inclusive`` also admits a rate of exactly ``min_rate``. Rows are in category
    order, lowest rate first, which is the order of a descending rank without ranking.
    Items without a category have no rate, so they never appear. ``dense_orders`` tells
    whether order ids lie close together, None if that is to be measured: then a category's
    orders are counted by bitmaps, see :func:`bitmap_distinct`.
    """
    pairs = _order_item_pairs(
        order_items.where(F.col(item).isNotNull()), first_day, last_day, order, item, order_time
    )
    categories = _categories(item_category, item, cluster).where(F.col(cluster).isNotNull())
    rated = join_lookup(
        _orders_per_item(pairs, order, item)
        .join(categories, item)
        .select(cluster, item, "total_item_per_cluster"),
        _orders_per_cluster(pairs, categories, order, item, cluster, dense_orders),
        keys=[cluster],
    ).withColumn(
        "contribution_rate",
        ratio(F.col("total_item_per_cluster"), F.col("total_order_per_cluster")),
    )
    rate = F.col("contribution_rate")
    return (
        rated.where(rate >= min_rate if inclusive else rate > min_rate)
        .orderBy(cluster, "contribution_rate", item)
        .select(item, cluster)
    )


def category_rates(
    order_items: DataFrame,
    item_category: DataFrame,
    first_day: Day,
    last_day: Day,
    order: str = "order_id",
    item: str = "item_id",
    order_time: str = "create_timestamp",
    cluster: str = "cluster",
) -> DataFrame:
    """Items per category: their counts, contribution rate and rank within the category.

    Within a category the rate falls with the item's order count, so the rank is found
    on the distinct counts: at most sqrt(2 x pairs) rows per category, instead of one
    window over all its items. Items without a category form a group of their own, in
    which total and rate are null; all its rates are equal, so every rank is 1.
    """
    # The null item has no category. It is counted apart: the joins would ask the pairs for
    # other items anyway, and so both their uses stay the same and share a shuffle.
    known = F.col(item).isNotNull()
    pairs = _order_item_pairs(
        order_items.where(known), first_day, last_day, order, item, order_time
    )
    categories = _categories(item_category, item, cluster)
    without_item = (
        order_items.where(~known & within_days(order_time, first_day, last_day))
        .groupBy(item)
        .agg(F.count_distinct(order).alias("total_item_per_cluster"))
        .select(F.lit(None).cast("string").alias(cluster), item, "total_item_per_cluster")
    )
    items = (
        _orders_per_item(pairs, order, item)
        .join(categories, item, "left")
        .select(cluster, item, "total_item_per_cluster")
        .unionByName(without_item)
    )
    totals = _orders_per_cluster(pairs, categories, order, item, cluster)

    busier = (
        Window.partitionBy(cluster)
        .orderBy(F.desc("total_item_per_cluster"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = (
        items.where(F.col(cluster).isNotNull())
        .groupBy(cluster, "total_item_per_cluster")
        .agg(F.count("*").alias("items"))
        .join(totals, cluster, "left")
        .select(
            cluster,
            "total_item_per_cluster",
            "total_order_per_cluster",
            (F.coalesce(F.sum("items").over(busier), F.lit(0)) + 1)
            .cast("int")
            .alias("contribution_rank"),
        )
    )
    return join_lookup(items, ranks, keys=[cluster, "total_item_per_cluster"]).select(
        cluster,
        item,
        "total_item_per_cluster",
        "total_order_per_cluster",
        ratio(F.col("total_item_per_cluster"), F.col("total_order_per_cluster")).alias(
            "contribution_rate"
        ),
        F.when(F.col(cluster).isNull(), 1).otherwise(F.col("contribution_rank")).alias("contribution_rank"),
    )


def _categories(item_category: DataFrame, item: str, cluster: str) -> DataFrame:
    """Distinct categories of items; a null item matches none."""
    return item_category.where(F.col(item).isNotNull()).select(item, cluster).distinct()


def _order_item_pairs(
    order_items: DataFrame, first_day: Day, last_day: Day, order: str, item: str, order_time: str
) -> DataFrame:
    """Distinct (order, item) of the window: all that distinct-order counts need.

    Grouped by the pair as one value, so that rows which arrive partitioned by order are
    spread again and an order with very many items does not stay in one task.
    """
    return (
        order_items.where(within_days(order_time, first_day, last_day))
        .select(F.struct(order, item).alias("pair"))
        .distinct()
        .select("pair.*")
    )


def _orders_per_item(pairs: DataFrame, order: str, item: str) -> DataFrame:
    """Distinct orders per item; counted before the category is joined on."""
    return pairs.groupBy(item).agg(F.count(order).alias("total_item_per_cluster"))


def _orders_per_cluster(
    pairs: DataFrame,
    categories: DataFrame,
    order: str,
    item: str,
    cluster: str,
    dense: bool | None = False,
) -> DataFrame:
    """Distinct orders per category.

    The join reads both sides straight from a shuffle on the item, so adaptive
    execution can split an item that is in a large part of all orders.
    """
    placed = pairs.join(categories.where(F.col(cluster).isNotNull()), item)
    if dense is not False:
        return bitmap_distinct(placed, [cluster], order, "total_order_per_cluster", dense)
    return placed.groupBy(cluster).agg(F.count_distinct(order).alias("total_order_per_cluster"))
