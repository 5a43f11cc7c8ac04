"""The shape of the plans: what is split, broadcast, shared and pruned."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from bazaarlens import operators as ops
from bazaarlens.operators.category import _orders_per_cluster
from bazaarlens.operators.joins import join_groups, join_lookup
from bazaarlens.plans import QUERIES, Marketplace

DATA = "/root/testdata/sf0.001"
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    """The plan as it ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


# Adaptive execution at the size of a test.
EAGER_SPLITS = {
    **NO_BROADCAST,
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """60,000 stored rows, a third of them with key 7, and some without a key."""
    path = str(tmp_path_factory.mktemp("skewed") / "rows")
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 50 == 1, None).otherwise(n % 5000)
    spark.range(0, 60_000, 1, 16).select(
        key.cast("bigint").alias("k"), F.xxhash64("id").alias("v")
    ).write.parquet(path)
    return spark.read.parquet(path)


def largest_partition(df):
    # The maxima keep the columns, and so the join and the size of its partitions.
    placed = df.groupBy(F.spark_partition_id()).agg(
        F.count("*").alias("size"), F.max("v"), F.max("top")
    )
    return max(r["size"] for r in placed.collect())


def test_hot_key_is_split_when_rows_join_their_groups(spark, skewed):
    counts = skewed.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top"))
    with settings(spark, **EAGER_SPLITS):
        joined = join_groups(skewed, counts, ["k"], "left")
        assert joined.columns == ["k", "v", "n", "top"]
        assert "skew=true" in plan(joined)
        # 8 partitions: an even share is 7,500 rows, the hot key alone has 20,000.
        assert largest_partition(joined) < 12_000
        # Without the null-safe match the hot key stays whole.
        plain = skewed.join(counts, "k", "left")
        assert "skew=true" not in plan(plain)
        assert largest_partition(plain) >= 20_000
        missing = skewed.where("k is null").count()
        assert joined.where("n is null").count() == 0
        assert joined.where("k is null and n = %d" % missing).count() == missing
        assert joined.where("k is not null").exceptAll(plain).count() == 0
        assert joined.count() == 60_000


@pytest.mark.parametrize("report", [ops.priority_status, ops.top30_model_flag])
def test_hot_model_is_split(spark, tmp_path, report):
    hot = F.col("id") % 3 == 0
    spark.range(0, 60_000, 1, 16).select(
        F.lit("ID").alias("region"),
        F.when(hot, 7).otherwise(F.col("id") % 5000).alias("item_id"),
        F.lit(1).cast("bigint").alias("model_id"),
        F.abs(F.xxhash64("id") % 5).alias("units"),
        F.when(hot, F.hex(F.xxhash64("id"))).otherwise("OWN < REF").alias("status"),
    ).write.parquet(f"{tmp_path}/pricing")
    with settings(spark, **EAGER_SPLITS):
        df = report(spark.read.parquet(f"{tmp_path}/pricing"))
        if report is ops.top30_model_flag:
            assert "skew=true" in plan(df)
        else:  # hot rows stay where they are read and meet a broadcast; the others share a window
            assert "BroadcastHashJoin" in plan(df)
            ranked = ops.status_priorities(spark.read.parquet(f"{tmp_path}/pricing"))
            placed = ranked.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("status"), F.max("priority"))
            assert max(r["n"] for r in placed.collect()) < 12_000
        # Rows of item 7 that are not hot have a better status than all hot rows.
        assert df.count() == (60_000 if report is ops.top30_model_flag else 40_000)


def test_lookup_is_broadcast_at_run_time_or_hot_keys_are_split(spark, skewed, tmp_path):
    listed = spark.createDataFrame([(7, "a"), (8, "b"), (8, "c"), (None, "d")], "k bigint, name string")
    # an aggregation by the key, whose size is known only when it has run
    lookup = listed.groupBy("k").agg(F.max("name").alias("name"), F.count("*").alias("n"))
    want = sorted(
        map(tuple, skewed.join(lookup, "k", "left").groupBy("name").count().collect()), key=repr
    )
    small = {"spark.sql.autoBroadcastJoinThreshold": "1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m"}
    for conf, word, other in [(small, "BroadcastHashJoin", "skew=true"), (EAGER_SPLITS, "skew=true", "BroadcastHashJoin")]:
        with settings(spark, **conf):
            df = join_lookup(skewed, lookup, ["k"])
            assert df.columns == ["k", "v", "name", "n"]
            text = plan(df)
            assert word in text and other not in text
            assert sorted(map(tuple, df.groupBy("name").count().collect()), key=repr) == want


def test_building_a_query_runs_no_job_for_its_lookup(spark):
    group = "no lookup job"
    spark.sparkContext.setJobGroup(group, group)
    for name in ["top30_ranked_models", "category_contribution", "top30_model_flag_repeated_region"]:
        QUERIES[name](spark, DATA)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_platform_sums_each_order_before_the_join(spark):
    with settings(spark, **NO_BROADCAST):
        text = plan(Marketplace(spark, DATA).platform())
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1
    # the tree lists a parent before its child: the join, the sum, the shuffle of its parts
    at = text.index("Exchange hashpartitioning(l_orderkey")
    assert "keys=[l_orderkey" in text[:at] and "Join" in text[: text.index("keys=[l_orderkey")]
    assert "partial_sum" in text[at:]


def test_preview_needs_no_shuffle(spark):
    text = plan(QUERIES["table_preview"](spark, DATA))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_hot_item_is_split_in_the_category_join(spark):
    hot = F.col("id") % 3 == 0
    pairs = spark.range(0, 200_000, 1, 16).select(
        F.xxhash64("id").alias("order_id"),
        F.when(hot, 7).otherwise(F.col("id") % 5000).cast("bigint").alias("item_id"),
    )
    categories = spark.range(5000).select(
        F.col("id").alias("item_id"), (F.col("id") % 9).cast("string").alias("cluster")
    )
    with settings(spark, **EAGER_SPLITS):
        totals = _orders_per_cluster(
            pairs.distinct(), categories.distinct(), "order_id", "item_id", "cluster"
        )
        assert "skew=true" in plan(totals)


@pytest.mark.parametrize("name", ["category_contribution", "category_rates"])
def test_order_item_pairs_are_shuffled_once(spark, name):
    with settings(spark, **NO_BROADCAST):
        text = plan(QUERIES[name](spark, DATA))
    # the rates read the lines without an item once more, by a filter that the scan gets
    assert text.count("Exchange hashpartitioning(l_orderkey") <= 1 + text.count("IsNull(l_suppkey)")
    assert text.count("ReusedExchange") >= 2


def test_scans_read_only_the_columns_in_use(spark):
    text = plan(QUERIES["distinct_orders"](spark, DATA))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    text = plan(QUERIES["order_lookup"](spark, DATA))
    assert "EqualTo(l_orderkey,1000)" in text and "EqualTo(o_orderkey,1000)" in text
    text = plan(QUERIES["first_purchase_daily"](spark, DATA))
    assert "EqualTo(p_type,ECONOMY)" in text


def test_no_query_needs_python_workers_or_cross_joins(spark):
    for name, query in QUERIES.items():
        text = query(spark, DATA)._jdf.queryExecution().executedPlan().toString()
        for word in ["Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"]:
            assert word not in text, (name, word)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[0] == "region"
    assert df.count() == 5
    assert ops.regional_scorecard.__name__ == "regional_scorecard"
