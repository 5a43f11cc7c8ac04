"""Every query by name, bound to the tables of a data directory."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens import operators as ops
from bazaarlens import sources
from bazaarlens.functions import StatusLabels
from bazaarlens.plans.marketplace import TABLE_NAMES, Marketplace

# The parameters of the registered queries.
BUYER_WINDOW = ("1995-04-01", "1995-04-30")
BUYER_CATEGORY = "ECONOMY"
CATEGORY_WINDOW = ("1997-07-01", "1997-07-31")
CATEGORY_RATE = 0.5
LOW_CATEGORY_RATE = 0.05
LOOKUP_ORDER_ID = 1000
PREVIEW_ROWS = 20
FLAG_BUCKETS = 8
#: Rows of a bucket of stored flags, about: a task sorts and groups a bucket in its memory.
BUCKET_ROWS = 500_000
REJECTED_UNITS = 4000

Query = Callable[[SparkSession, str], DataFrame]


def _query(build: Callable[[Marketplace], DataFrame]) -> Query:
    return lambda spark, directory: build(Marketplace(spark, directory))


def _list_tables(m: Marketplace) -> DataFrame:
    """Names from the catalog with row counts, of views that exist for this query only."""
    prefix = f"listed_{uuid.uuid4().hex}_"
    try:
        sources.register_tables({prefix + name: m.table(name) for name in TABLE_NAMES})
        listed = sources.list_tables(m.spark, f"{prefix}*").select("tableName")
        counts = ops.row_counts(m.spark, [prefix + name for name in TABLE_NAMES])
        named = listed.join(counts, F.col("tableName") == F.col("table_name"))
        return named.select(
            F.substring("tableName", len(prefix) + 1, 100).alias("table_name"), "row_count"
        )
    finally:
        for name in TABLE_NAMES:
            m.spark.catalog.dropTempView(prefix + name)


def _published_flags(m: Marketplace) -> DataFrame:
    """An exported pricing table is cleaned, flagged without its index column, published
    under a name of its own and read back by SQL."""
    exported = m.pricing().withColumnRenamed("region", "grass_region")
    exported = exported.withColumn("_c0", F.lit(0))
    name = f"flags_{uuid.uuid4().hex}"
    sources.publish(ops.top30_model_flag(sources.clean(exported)), name)
    try:
        return m.spark.sql(
            "SELECT region, is_top_30_model, count(*) AS row_count, sum(units) AS units "
            f"FROM {name} GROUP BY region, is_top_30_model"
        )
    finally:
        m.spark.catalog.dropTempView(name)


def _stored_flags(m: Marketplace) -> DataFrame:
    """The flags stored by model in buckets, read back with the units of each model beside its
    rows: no shuffle on the three keys. The table goes once the result is written. There are
    FLAG_BUCKETS buckets, more from so many times BUCKET_ROWS lines on."""
    name = f"flags_{uuid.uuid4().hex}"
    key = ["region", "item_id", "model_id"]
    hot = ops.hot_keys(m.offers(), ["item_id", "model_id"])
    flags = ops.top30_model_flag(m.pricing(), hot=hot)
    buckets = max(FLAG_BUCKETS, math.ceil(hot.rows / BUCKET_ROWS))
    sources.shared_dir(m.spark)
    try:
        stored = sources.publish(flags, name, persistent=True, keys=key, buckets=buckets)
        models = stored.groupBy(*key).agg(F.sum("units").alias("model_units"))
        joined = stored.join(models, key)
        result = joined.groupBy("region", "is_top_30_model").agg(
            F.count("*").alias("row_count"),
            F.sum("units").alias("units"),
            F.max("model_units").alias("largest_model_units"),
        )
        return result.checkpoint(eager=True)
    finally:
        m.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _exported(m: Marketplace, units: Column) -> str:
    """The pricing view as CSV in two folders whose files differ in the order of columns and in
    one column that only the second has."""
    folder = sources.new_folder(m.spark, "csv")
    rows = m.pricing().withColumn("units", units)
    cheaper = F.coalesce(F.col("status") == StatusLabels().cheaper, F.lit(False))
    first = rows.where(cheaper).select("region", "item_id", "model_id", "status", "units")
    second = rows.where(~cheaper).select(
        "units", F.lit("dearer or equal").alias("note"), "model_id", "status", "item_id", "region"
    )
    for name, part in (("first", first), ("second", second)):
        part.write.option("header", True).csv(f"{folder}/{name}")
    return f"{folder}/*"


def _scorecard_from_csv(m: Marketplace) -> DataFrame:
    """The scorecard over files whose headers differ, and a stored lookup."""
    pricing = sources.read_csv(m.spark, _exported(m, F.col("units")), sources.schemas.PRICING)
    stored = f"{sources.new_folder(m.spark, 'csv')}/platform"
    exported = m.platform().withColumnRenamed("platform_order", "platform order")
    exported.write.option("header", True).csv(stored)
    return ops.regional_scorecard(pricing, sources.read_csv(m.spark, stored, sources.schemas.PLATFORM))


def _rejected_prices(m: Marketplace) -> DataFrame:
    """Files in which the units of some lines are no number: what is read, and what is rejected."""
    wrong = F.concat(F.lit("x"), F.col("units"))
    path = _exported(m, F.when(F.col("units") > REJECTED_UNITS, wrong).otherwise(F.col("units").cast("string")))
    rows = sources.read_csv(m.spark, path, sources.schemas.PRICING, rejected="rejected")
    accepted, rejected = sources.split_rejected(rows, "rejected")
    read = accepted.groupBy("region").agg(F.count("*").alias("row_count"), F.sum("units").alias("units"))
    lost = rejected.groupBy(F.array_join("columns", ",").alias("rejected_columns")).agg(F.count("*").alias("row_count"))
    return read.withColumn("rejected_columns", F.lit(None).cast("string")).unionByName(lost, allowMissingColumns=True)


def _contribution(m: Marketplace, min_rate: float, inclusive: bool = False) -> DataFrame:
    return ops.category_contribution(
        m.order_items(),
        m.item_category(),
        *CATEGORY_WINDOW,
        min_rate=min_rate,
        inclusive=inclusive,
        dense_orders=True,
    )


QUERIES: dict[str, Query] = {
    name: _query(build)
    for name, build in {
        # Buyers and categories
        "duplicate_keys": lambda m: ops.duplicate_keys(m.table("orders"), "o_custkey"),
        "first_purchase_daily": lambda m: ops.first_purchase_daily(
            m.first_purchase(), m.order_item(), *BUYER_WINDOW, BUYER_CATEGORY
        ),
        "first_purchase_daily_filled": lambda m: ops.first_purchase_daily_filled(
            m.first_purchase(), m.order_item(), *BUYER_WINDOW, BUYER_CATEGORY
        ),
        "categorised_orders": lambda m: ops.categorised_orders(
            m.order_items(), m.item_category(), *CATEGORY_WINDOW
        ),
        "category_contribution": lambda m: _contribution(m, CATEGORY_RATE),
        "category_contribution_inclusive": lambda m: _contribution(
            m, CATEGORY_RATE, inclusive=True
        ),
        "category_contribution_low_rate": lambda m: _contribution(m, LOW_CATEGORY_RATE),
        "category_rates": lambda m: ops.category_rates(
            m.order_items(), m.item_category(), *CATEGORY_WINDOW
        ),
        # Regional scorecard
        "order_coverage": lambda m: ops.order_coverage(m.pricing(), m.platform()),
        "order_coverage_repeated_region": lambda m: ops.order_coverage(
            m.pricing(), m.platform_by_nation()
        ),
        "item_count_by_region": lambda m: ops.item_count_by_region(m.pricing()),
        "status_count_by_region": lambda m: ops.status_count_by_region(m.pricing()),
        "net_competitiveness": lambda m: ops.net_competitiveness(m.pricing()),
        "regional_scorecard": lambda m: ops.regional_scorecard(m.pricing(), m.platform()),
        "scorecard_from_csv": _scorecard_from_csv,
        "rejected_prices": _rejected_prices,
        # Price status and order threshold per model
        "status_priorities": lambda m: ops.status_priorities(m.offers()),
        "priority_status": lambda m: ops.priority_status(m.offers()),
        "top30_item_count": lambda m: ops.top30_item_count(m.pricing(), dense_items=True),
        "top30_item_count_strict": lambda m: ops.top30_item_count(
            m.pricing(), text_threshold=False
        ),
        "top30_item_count_text": lambda m: ops.top30_item_count(
            m.pricing(), text_threshold=True
        ),
        "top30_ranked_models": lambda m: ops.top30_ranked_models(m.pricing(), m.platform()),
        "top30_ranked_models_repeated_region": lambda m: ops.top30_ranked_models(
            m.pricing(), m.platform_by_nation()
        ),
        "top30_ranked_models_ascending": lambda m: ops.top30_ranked_models(
            m.pricing(), m.platform_by_nation(), descending=False
        ),
        # The derived lookup lists each region once, so the flag does not need it.
        "top30_model_flag": lambda m: ops.top30_model_flag(
            m.pricing(), hot=ops.hot_keys(m.offers(), ["item_id", "model_id"])
        ),
        "top30_model_flag_repeated_region": lambda m: ops.top30_model_flag(
            m.pricing(), m.platform_by_nation()
        ),
        "published_flags": _published_flags,
        "stored_flags": _stored_flags,
        # Checks on the order lines
        "distinct_orders": lambda m: ops.distinct_count(
            m.order_lines(), ["order_id"], "distinct_orders", dense=True
        ),
        "distinct_order_items": lambda m: ops.distinct_count(
            m.order_lines(), ["order_id", "item_id"], "distinct_order_items"
        ),
        "distinct_items": lambda m: ops.distinct_count(
            m.order_lines(), ["item_id"], "distinct_items", dense=True
        ),
        "distinct_items_by_region": lambda m: ops.bitmap_distinct(
            m.pricing(), ["region"], "item_id", "distinct_items"
        ),
        "distinct_item_statuses": lambda m: ops.distinct_count(
            m.offers(), ["item_id", "status"], "distinct_item_statuses"
        ),
        "order_item_multiplicity": lambda m: ops.key_multiplicity(
            m.order_lines(), ["order_id", "item_id"], sort_by="item_id"
        ),
        "order_lookup": lambda m: ops.rows_with_key(
            m.order_items(), "order_id", LOOKUP_ORDER_ID
        ),
        "table_preview": lambda m: ops.preview(
            m.table("lineitem"), PREVIEW_ROWS, ["l_orderkey", "l_linenumber"]
        ),
        "list_tables": _list_tables,
    }.items()
}
