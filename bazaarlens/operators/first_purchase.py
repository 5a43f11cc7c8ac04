"""First-time buyers per day, matched to order rows of one category.

Expected columns, all renamable by keyword: ``first_purchase(buyer_id,
first_purchase_time)`` and ``order_item(buyer_id, create_datetime, cluster)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.dates import Day, day_of, each_day, within_days


def first_purchase_daily(
    first_purchase: DataFrame,
    order_item: DataFrame,
    first_day: Day,
    last_day: Day,
    category: str,
    buyer: str = "buyer_id",
    purchase_time: str = "first_purchase_time",
    order_time: str = "create_datetime",
    cluster: str = "cluster",
) -> DataFrame:
    """Matched rows per day of first purchase, for the days that have any.

    The count is of (first purchase, order row) pairs that share a buyer, both inside
    the window, the order row in ``category``. A buyer with three such order rows adds
    three, and none of them need be the first purchase itself.
    """
    return _matches_per_day(
        first_purchase, order_item, first_day, last_day, category,
        buyer, purchase_time, order_time, cluster,
    ).orderBy("create_date")


def first_purchase_daily_filled(
    first_purchase: DataFrame,
    order_item: DataFrame,
    first_day: Day,
    last_day: Day,
    category: str,
    buyer: str = "buyer_id",
    purchase_time: str = "first_purchase_time",
    order_time: str = "create_datetime",
    cluster: str = "cluster",
) -> DataFrame:
    """As :func:`first_purchase_daily`, with every day of the window and 0 for none."""
    counts = _matches_per_day(
        first_purchase, order_item, first_day, last_day, category,
        buyer, purchase_time, order_time, cluster,
    )
    spine = first_purchase.sparkSession.range(1).select(
        each_day(first_day, last_day).alias("create_date")
    )
    return (
        spine.join(counts, "create_date", "left")
        .select(
            "create_date",
            F.coalesce("num_of_first_purchase_buyers", F.lit(0)).alias(
                "num_of_first_purchase_buyers"
            ),
        )
        .orderBy("create_date")
    )


def _matches_per_day(
    first_purchase: DataFrame,
    order_item: DataFrame,
    first_day: Day,
    last_day: Day,
    category: str,
    buyer: str,
    purchase_time: str,
    order_time: str,
    cluster: str,
) -> DataFrame:
    # Both sides are counted per buyer before they meet: pairs = product of the counts.
    # The shuffle then carries one row per buyer (and day), however hot a buyer is.
    newcomers = (
        first_purchase.where(within_days(purchase_time, first_day, last_day))
        .groupBy(buyer, day_of(purchase_time).alias("create_date"))
        .agg(F.count("*").alias("purchases"))
    )
    orders = (
        order_item.where(
            within_days(order_time, first_day, last_day) & (F.col(cluster) == category)
        )
        .groupBy(buyer)
        .agg(F.count("*").alias("order_rows"))
    )
    return (
        newcomers.join(orders, buyer)
        .groupBy("create_date")
        .agg(
            F.sum(F.col("purchases") * F.col("order_rows")).alias("num_of_first_purchase_buyers")
        )
    )
