"""Hot keys, bitmaps, buckets and run-time filters: results against plain forms, and plans."""

import random

import pytest
from pyspark.sql import functions as F

from bazaarlens import operators as ops
from bazaarlens import sources
from bazaarlens.plans import QUERIES, registry
from bazaarlens.plans.marketplace import Marketplace

DATA = "/root/testdata/sf0.01"


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan()


def text_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def moved(plan):
    """Bytes that exchanges wrote."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return moved(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return moved(plan.plan())
    own = plan.metrics().apply("shuffleBytesWritten").value() if plan.nodeName() == "Exchange" else 0
    return own + sum(moved(plan.children().apply(i)) for i in range(plan.children().size()))


def skewed(spark, n=6000):
    dice = random.Random(1)
    rows = []
    for i in range(n):
        item = 1 if i % 3 == 0 else None if i % 7 == 0 else dice.randrange(1, n)
        rows.append((dice.choice(["MY", "SG", None]), item, None if i % 11 == 0 else dice.randrange(2), dice.choice(["OWN < REF", "OWN = REF", None]), dice.randrange(9)))
    return spark.createDataFrame(rows, "region string, item_id bigint, model_id bigint, status string, units bigint")


@pytest.mark.parametrize("shares", [0.001, 0.5, 1e9])
def test_values_beside_rows(spark, shares):
    rows = skewed(spark)
    key = ["item_id", "model_id"]
    hot = ops.hot_keys(rows, key, shares)
    assert bool(hot.hashes) == (shares < 1e9)
    values = {"least": F.min("status"), "total": F.sum("units"), "n": F.count("*")}
    got = ops.with_key_values(rows, key, values, hot)
    groups = rows.groupBy(*key).agg(*[v.alias(k) for k, v in values.items()])
    want = ops.join_groups(rows, groups, key, "inner")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_hot_keys_are_those_with_many_rows(spark):
    rows = skewed(spark)
    hot = ops.hot_keys(rows, ["item_id"])
    counts = {r["item_id"]: r["count"] for r in rows.groupBy("item_id").count().collect()}
    found = {r["item_id"] for r in rows.where(hot.match()).select("item_id").distinct().collect()}
    assert found == {k for k, n in counts.items() if n >= 0.5 * 6000 / 8} == {1, None}
    assert ops.hot_keys(rows.where("false"), ["item_id"]).hashes == ()


@pytest.mark.parametrize("with_platform", [False, True])
@pytest.mark.parametrize("text_threshold", [False, True])
def test_flags_by_window_are_those_of_the_join(spark, with_platform, text_threshold):
    rows = skewed(spark).withColumn("_c0", F.lit(1))
    platform = spark.createDataFrame([("MY", 5), ("MY", 7), ("SG", 2), (None, 1)], "region string, platform_order bigint")
    platform = platform if with_platform else None
    plain = ops.top30_model_flag(rows, platform, text_threshold=text_threshold)
    hot = ops.hot_keys(rows, ["item_id"])
    assert hot.hashes
    got = ops.top30_model_flag(rows, platform, text_threshold=text_threshold, hot=hot)
    assert got.columns == plain.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_priorities_shuffle_rows_once(spark):
    market = Marketplace(spark, DATA)
    plan = text_of(ops.status_priorities(market.offers()))
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" in plan


def test_a_hot_model_meets_no_window(spark):
    """The rows of a hot model are aggregated in each task and joined by a broadcast."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("item_id"),
        F.lit(1).cast("bigint").alias("model_id"), F.lit("OWN < REF").alias("status"),
    )
    ranked = ops.status_priorities(rows)
    plan = text_of(ranked)
    assert "BroadcastHashJoin" in plan
    assert ranked.count() == 40_000 and ranked.where("priority = 1").count() == 40_000


IDS = [
    [], [None], [0, 0, None], [1, 32768, 32769, -1, -32767, -32768, -32769, 0],
    [2**63 - 1, -(2**63), 2**62, -(2**62), None, 5, 5],
]


@pytest.mark.parametrize("dense", [True, False, None])
@pytest.mark.parametrize("ids", IDS)
def test_bitmaps_count_all_ids(spark, ids, dense):
    rows = spark.createDataFrame([(i % 2 if i % 5 else None, x) for i, x in enumerate(ids)], "g int, x bigint")
    whole = ops.distinct_count(rows, ["x"], "n", dense=dense).collect()
    assert [r["n"] for r in whole] == [len(set(ids) - {None})]
    got = ops.bitmap_distinct(rows, ["g"], "x", "n", dense)
    want = rows.groupBy("g").agg(F.count_distinct("x").alias("n"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.dtypes == want.dtypes


def test_dense_and_sparse_buckets_go_their_ways(spark):
    """Bucket by bucket: ids that lie close together by bitmaps, the others by pairs."""
    near = spark.range(0, 60_000, 1, 2).select((F.col("id") % 20_000).alias("x"))
    far = spark.range(0, 3_000, 1, 2).select((F.col("id") * 1_000_003).alias("x"))
    rows = near.union(far).select((F.col("x") % 2).alias("g"), "x")
    got = ops.bitmap_distinct(rows, ["g"], "x", "n")
    want = rows.groupBy("g").agg(F.count_distinct("x").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_bitmaps_move_less_than_pairs(spark):
    rows = Marketplace(spark, DATA).order_lines().repartition(8)
    rows = spark.createDataFrame(rows.rdd, rows.schema)
    pairs = executed(ops.distinct_count(rows, ["order_id"], "n"))
    bits = executed(ops.distinct_count(rows, ["order_id"], "n", dense=True))
    assert "bitmap_construct_agg" in bits.toString() and "bitmap_construct_agg" not in pairs.toString()
    assert moved(bits) < 0.5 * moved(pairs)


def test_a_stored_flag_needs_no_shuffle_on_its_keys(spark):
    key = ["region", "item_id", "model_id"]
    flags = ops.top30_model_flag(skewed(spark))
    try:
        stored = sources.publish(flags, "bucketed_flags", persistent=True, overwrite=True, keys=key, buckets=4)
        models = stored.groupBy(*key).agg(F.sum("units").alias("model_units"))
        joined = stored.join(models, key)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = text_of(joined)
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert joined.count() == flags.where(" AND ".join(f"{k} IS NOT NULL" for k in key)).count()
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("flags_")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS bucketed_flags")
    with pytest.raises(ValueError, match="persistent"):
        sources.publish(flags, "x", keys=key, buckets=4)


def test_the_registered_stored_flag_cleans_up(spark):
    before = {t.name for t in spark.catalog.listTables()}
    QUERIES["stored_flags"](spark, DATA).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_stored_flags_have_more_buckets_for_more_rows(spark, monkeypatch):
    lines = Marketplace(spark, DATA).table("lineitem").count()
    assert ops.hot_keys(Marketplace(spark, DATA).offers(), ["item_id"]).rows == lines
    publish, buckets, found = sources.publish, [], []

    def seen(*args, **options):
        buckets.append(options["buckets"])
        return publish(*args, **options)

    monkeypatch.setattr(sources, "publish", seen)
    for rows in (10 * lines, lines // 19):
        monkeypatch.setattr(registry, "BUCKET_ROWS", rows)
        found.append(sorted(map(tuple, QUERIES["stored_flags"](spark, DATA).collect()), key=repr))
    assert buckets == [registry.FLAG_BUCKETS, 20]
    assert found[0] == found[1]


@pytest.mark.parametrize("name", ["categorised_orders", "first_purchase_daily"])
def test_a_month_of_orders_filters_the_lines_at_run_time(spark, name):
    """On a large table the orders of the window become a Bloom filter on the scan of the lines."""
    settings = {
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = text_of(QUERIES[name](spark, DATA))
        assert "might_contain" in plan and "bloom_filter_agg" in plan
    finally:
        for k in settings:
            spark.conf.unset(k)
