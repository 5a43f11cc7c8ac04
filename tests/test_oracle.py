"""Every registered query against its SQL in DuckDB, values and types."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as driver
from bazaarlens.plans import ORACLE_SQL, QUERIES, TABLE_NAMES

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.12g}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(
        (tuple(normal(r[i]) for i in order) for r in rows), key=repr
    )


# Spark type -> DuckDB type
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    sql = ORACLE_SQL[name]
    expected = duck.execute(sql)
    columns = [d[0] for d in expected.description]
    want = table(columns, expected.fetchall())
    got = table(df.columns, df.collect())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]
    described = duck.execute(f"DESCRIBE {sql}").fetchall()
    assert {c: TYPES[t] for c, t in df.dtypes} == {r[0]: r[1] for r in described}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE_SQL) <= set(driver.oracle_sql()) <= set(driver.queries())
