import datetime

import pytest
from pyspark.sql import functions as F

from bazaarlens.functions import (
    each_day,
    fixed_text,
    last_admitted_rank,
    ratio,
    status_rank,
    threshold_text,
    within_days,
)


def values(df):
    return [r[0] for r in df.collect()]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_window_includes_the_whole_last_day(spark, kind):
    moments = [
        "2021-03-31 23:59:59.999999",
        "2021-04-01 00:00:00",
        "2021-04-30 23:59:59.999999",
        "2021-05-01 00:00:00",
        None,
    ]
    df = spark.createDataFrame([(m,) for m in moments], "t string").select(
        F.col("t").cast(kind).alias("t")
    )
    inside = within_days("t", "2021-04-01", datetime.date(2021, 4, 30))
    assert values(df.select(inside)) == [False, True, True, False, None]
    day_form = F.to_date("t").between(
        F.lit(datetime.date(2021, 4, 1)), F.lit(datetime.date(2021, 4, 30))
    )
    assert df.where(inside != day_form).count() == 0


def test_window_is_pushed_to_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = (
        df.where(within_days("o_orderdate", "1995-04-01", "1995-04-30"))
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(o_orderdate,1995-04-01" in pushed
    assert "LessThan(o_orderdate,1" in pushed


def test_each_day_across_a_leap_day(spark):
    df = spark.range(1).select(each_day("2024-02-28", "2024-03-01"))
    assert values(df) == [
        datetime.date(2024, 2, 28),
        datetime.date(2024, 2, 29),
        datetime.date(2024, 3, 1),
    ]


def test_ratio_never_fails(spark):
    df = spark.createDataFrame(
        [(1, 4), (1, 0), (None, 3), (3, None), (0, 5)], "a bigint, b bigint"
    )
    assert values(df.select(ratio(F.col("a"), F.col("b")))) == [0.25, None, None, None, 0.0]


def test_fixed_text_rounds_half_even_with_commas(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (1234567.25,), (None,)], "x double")
    assert values(df.select(fixed_text(F.col("x"), 0))) == ["0", "2", "2", "1,234,567", None]
    assert values(df.select(fixed_text(F.col("x"), 6)))[3] == "1,234,567.250000"


def test_admitted_rank_is_the_threshold_text_as_a_number(spark):
    """Equal, for every total, to parsing the text; with a comma it does not parse."""
    totals = (
        spark.range(-5_000, 300_000)
        .union(spark.range(10**12, 10**12 + 1000))
        .union(spark.range(2**53 - 500, 2**53 + 500))
        .select(F.col("id").alias("total"))
    )
    text = threshold_text(F.col("total"), 0.3)
    plain = last_admitted_rank(F.col("total"), 0.3, text_threshold=True)
    strict = last_admitted_rank(F.col("total"), 0.3)
    wrong = totals.where(
        ~plain.eqNullSafe(text.try_cast("bigint"))
        | ~strict.eqNullSafe(F.translate(text, ",", "").try_cast("bigint"))
    )
    assert wrong.count() == 0


def test_admitted_rank_boundaries(spark):
    totals = [1, 2, 3, 5, 3330, 3331, 3332, None]
    df = spark.createDataFrame([(t,) for t in totals], "total bigint")
    assert values(df.select(last_admitted_rank(F.col("total"), 0.3, True))) == [
        0, 1, 1, 2, 999, 999, None, None,
    ]
    assert values(df.select(last_admitted_rank(F.col("total"), 0.3)))[-2:] == [1000, None]


def test_status_rank(spark):
    statuses = ["OWN < REF", "OWN = REF", "OWN > REF", "no match", None]
    df = spark.createDataFrame([(s,) for s in statuses], "s string")
    assert values(df.select(status_rank(F.col("s")))) == [1, 2, 3, 4, 4]
