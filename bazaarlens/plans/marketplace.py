"""The marketplace tables as views over an orders / line items star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.functions import StatusLabels

# The tables of one data directory.
TABLE_NAMES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]

# The columns of the tables. Declared, so that no file is opened before the
# query runs.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
        "c_mktsegment STRING"
    ),
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


#: The discount up to which a line counts as our own sale.
OWN_DISCOUNT = 0.05


class Marketplace:
    """Lazy views over the Parquet tables of one directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read
            if name in SCHEMAS:
                reader = reader.schema(SCHEMAS[name])
            self._tables[name] = reader.parquet(f"{self.directory}/{name}.parquet")
        return self._tables[name]

    def offers(self) -> DataFrame:
        """(item_id, model_id, status), one row per line, for what needs no region."""
        return self.table("lineitem").select(_item(), _model(), _status())

    def pricing(self) -> DataFrame:
        """(region, item_id, model_id, units, status), one row per placed line.

        Lines with a discount above OWN_DISCOUNT were sold by others: their units are 0.
        """
        return (
            self.table("lineitem")
            .join(self._orders_with_place(), F.col("l_orderkey") == F.col("o_orderkey"))
            .select("region", _item(), _model(), _own_units(), _status())
        )

    def platform(self) -> DataFrame:
        """(region, platform_order): the units of all lines, one row per region."""
        return self._platform_by("region")

    def platform_by_nation(self) -> DataFrame:
        """A lookup that lists each region once per nation."""
        return self._platform_by("region", "nation")

    def order_item(self) -> DataFrame:
        """(buyer_id, create_datetime, cluster), one row per order line."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self.table("lineitem").select("l_orderkey", "l_partkey")
        parts = self.table("part").select("p_partkey", "p_type")
        return (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("o_custkey").alias("buyer_id"),
                F.col("o_orderdate").alias("create_datetime"),
                F.col("p_type").alias("cluster"),
            )
        )

    def first_purchase(self) -> DataFrame:
        """(buyer_id, first_purchase_time), one row per buyer."""
        return (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("buyer_id"))
            .agg(F.min("o_orderdate").alias("first_purchase_time"))
        )

    def order_items(self) -> DataFrame:
        """(order_id, item_id, create_timestamp), one row per order line."""
        orders = self.table("orders").select("o_orderkey", "o_orderdate")
        lines = self.table("lineitem").select("l_orderkey", "l_suppkey")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_suppkey").alias("item_id"),
            F.col("o_orderdate").alias("create_timestamp"),
        )

    def order_lines(self) -> DataFrame:
        """(order_id, item_id): the order lines where their time is not needed."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("item_id")
        )

    def item_category(self) -> DataFrame:
        """(item_id, cluster), one row per item."""
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("item_id"), F.col("n_name").alias("cluster"))
        )

    def _orders_with_place(self) -> DataFrame:
        """(o_orderkey, region, nation): built before the lines are joined, so that the
        line items shuffle once, on the order. A null region name stays a region.
        """
        places = (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                "n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region")
            )
        )
        customers = (
            self.table("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "region", "nation")
        )
        return (
            self.table("orders")
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "region", "nation")
        )

    def _platform_by(self, *place: str) -> DataFrame:
        """Units are summed per order before the join, which that sum is partitioned for."""
        per_order = (
            self.table("lineitem").groupBy("l_orderkey").agg(F.sum(_units()).alias("order_units"))
        )
        return (
            per_order.join(self._orders_with_place(), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(*place)
            .agg(F.sum("order_units").alias("platform_order"))
            .select("region", "platform_order")
        )


def _item() -> Column:
    return F.col("l_partkey").alias("item_id")


def _model() -> Column:
    return (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("model_id")


def _units() -> Column:
    quantity = F.col("l_quantity")
    return (2 * quantity * quantity - 2).cast("bigint").alias("units")


def _own_units() -> Column:
    ours = F.col("l_discount") <= OWN_DISCOUNT
    return F.when(ours, _units()).otherwise(F.lit(0)).cast("bigint").alias("units")


def _status() -> Column:
    labels = StatusLabels()
    return (
        F.when(F.col("l_returnflag") == "A", labels.cheaper)
        .when(F.col("l_returnflag") == "N", labels.equal)
        .when(F.col("l_linestatus") == "F", labels.dearer)
        .alias("status")
    )
