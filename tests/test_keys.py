import pytest

from bazaarlens import operators as ops


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (3,), (3,), (3,)], "id bigint")
    result = ops.duplicate_keys(df, "id")
    assert result.columns == ["id", "count_duplicated"]
    assert [tuple(r) for r in result.collect()] == [(None, 2), (1, 2), (3, 3)]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(
        [(1, 5), (1, 5), (1, 6), (2, 5), (None, 5), (3, None), (3, None)],
        "order_id bigint, item_id bigint",
    )


def test_distinct_counts_ignore_nulls(lines):
    def count(*columns):
        return ops.distinct_count(lines, columns, "n").collect()[0][0]

    assert count("order_id") == 3
    assert count("item_id") == 2
    assert count("order_id", "item_id") == 3


def test_key_multiplicity_is_sorted(lines):
    rows = ops.key_multiplicity(lines, ["order_id", "item_id"], sort_by="item_id").collect()
    assert [tuple(r) for r in rows] == [
        (3, None, 2), (None, 5, 1), (1, 5, 2), (2, 5, 1), (1, 6, 1),
    ]


def test_rows_with_key_takes_64_bit_ids(spark):
    big = 173463513220909
    df = spark.createDataFrame([(big, "a"), (big, "b"), (1, "c")], "order_id bigint, v string")
    assert {r["v"] for r in ops.rows_with_key(df, "order_id", big).collect()} == {"a", "b"}


def test_preview(lines):
    assert ops.preview(lines, 3).count() == 3
    assert ops.preview(lines).count() == 7
    assert [tuple(r) for r in ops.preview(lines, 2, ["item_id", "order_id"]).collect()] == [
        (3, None),
        (3, None),
    ]


def test_row_counts(spark, lines):
    lines.createOrReplaceTempView("counted_lines")
    lines.limit(0).createOrReplaceTempView("counted_nothing")
    rows = ops.row_counts(spark, ["counted_lines", "counted_nothing"]).collect()
    assert {tuple(r) for r in rows} == {("counted_lines", 7), ("counted_nothing", 0)}
