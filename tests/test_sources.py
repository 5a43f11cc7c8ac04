import datetime

import pytest
from pyspark.errors import AnalysisException

from bazaarlens import operators as ops
from bazaarlens import sources
from bazaarlens.plans import QUERIES, TABLE_NAMES
from bazaarlens.plans.marketplace import SCHEMAS, Marketplace
from bazaarlens.sources import schemas

PRICING_CSV = """\
,grass_region,item_id,model_id,status,units
0,ID,580861,9019764370,OWN > REF,10
1,ID,580861,9019764371,OWN < REF,4
2,MY,,9863435317,,2
"""
PLATFORM_CSV = """\
,region,platform order
0,ID,28
1,MY,8
"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "pricing.csv").write_text(PRICING_CSV)
    (tmp_path / "platform_number.csv").write_text(PLATFORM_CSV)
    return str(tmp_path)


def test_inferred_csv_from_file_to_scorecard(spark, folder):
    tables = sources.read_tables(spark, folder, ["pricing", "platform_number"], fmt="csv")
    assert tables["pricing"].columns[0] == "_c0"
    pricing = sources.clean(tables["pricing"])
    platform = sources.clean(tables["platform_number"])
    assert dict(pricing.dtypes)["model_id"] == "bigint"
    assert "platform_order" in platform.columns
    rows = {r[0]: tuple(r)[1:] for r in ops.regional_scorecard(pricing, platform).collect()}
    assert rows == {"ID": ("0.500000", "0.000000", 2), "MY": ("0.250000", None, 0)}
    flags = ops.top30_model_flag(pricing, platform)
    assert "_c0" not in flags.columns
    assert {r["model_id"]: r["is_top_30_model"] for r in flags.collect()} == {
        9019764370: 1,
        9019764371: 1,
        9863435317: 0,  # no item id
    }


def test_declared_schema_gives_the_same_rows(spark, folder):
    declared = sources.read_csv(spark, f"{folder}/pricing.csv", schemas.PRICING)
    inferred = sources.clean(sources.read_csv(spark, f"{folder}/pricing.csv"))
    assert declared.columns == inferred.columns
    assert sorted(map(str, declared.collect())) == sorted(map(str, inferred.collect()))
    platform = sources.read_csv(spark, f"{folder}/platform_number.csv", schemas.PLATFORM)
    assert {tuple(r) for r in platform.collect()} == {(0, "ID", 28), (1, "MY", 8)}


def test_declared_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "moved.csv").write_text(
        ",model_id,item_id,note,grass_region,units,status\n0,9019764370,580861,x,ID,10,OWN > REF\n"
    )
    df = sources.read_csv(spark, f"{tmp_path}/moved.csv", schemas.PRICING)
    row = df.collect()[0].asDict()
    assert row == {
        "_c0": 0, "model_id": 9019764370, "item_id": 580861, "note": "x", "region": "ID", "units": 10,
        "status": "OWN > REF",
    }
    assert dict(df.dtypes)["units"] == "bigint"
    (tmp_path / "short.csv").write_text("item_id,model_id,status,units\n1,2,x,3\n")
    with pytest.raises(ValueError, match="has no column region"):
        sources.read_csv(spark, f"{tmp_path}/short.csv", schemas.PRICING)


def test_list_tables_leaves_the_views_of_the_session_alone(spark):
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("orders")
    before = {t.name for t in spark.catalog.listTables()}
    rows = QUERIES["list_tables"](spark, "/root/testdata/sf0.001").collect()
    assert {r["table_name"] for r in rows} == set(TABLE_NAMES)
    assert spark.table("orders").columns == ["x"]
    assert {t.name for t in spark.catalog.listTables()} == before
    spark.catalog.dropTempView("orders")


def test_every_line_is_in_the_pricing_table(spark):
    market = Marketplace(spark, "/root/testdata/sf0.001")
    lines = market.table("lineitem").count()
    assert market.pricing().count() == lines
    assert ops.top30_model_flag(market.pricing()).count() == lines


def test_timestamps_from_csv(spark, tmp_path):
    (tmp_path / "order_items.csv").write_text(
        ",order_id,item_id,create_timestamp\n0,173463513220909,5,2024-07-31 23:59:59\n"
    )
    for schema in [None, schemas.ORDER_ITEMS]:
        df = sources.read_csv(spark, f"{tmp_path}/order_items.csv", schema)
        categories = spark.createDataFrame([(5, "A")], "item_id bigint, cluster string")
        row = ops.categorised_orders(df, categories, "2024-07-01", "2024-07-31").collect()[0]
        assert tuple(row) == (173463513220909, 5, datetime.date(2024, 7, 31), "A")


def test_register_and_list_tables(spark, folder):
    sources.register_tables(
        sources.read_tables(spark, folder, ["platform_number"], fmt="csv")
    )
    assert "platform_number" in {r["tableName"] for r in sources.list_tables(spark).collect()}
    query = "SELECT `platform order` FROM platform_number WHERE region = 'MY'"
    assert spark.sql(query).collect()[0][0] == 8


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
def test_declared_star_schemas_are_those_of_the_files(spark, scale):
    market = Marketplace(spark, f"/root/testdata/sf{scale}")
    for name in SCHEMAS:
        stored = spark.read.parquet(f"{market.directory}/{name}.parquet")
        assert market.table(name).dtypes == stored.dtypes, name


def test_publish_as_view_and_as_table(spark):
    df = spark.createDataFrame([(1, 1)], "model_id bigint, is_top_30_model int")
    assert sources.publish(df).collect() == df.collect()
    assert spark.table("local_price_competitive_by_sku").count() == 1
    assert sources.publish(df, "kept_flags", persistent=True).collect() == df.collect()
    kept = [t for t in spark.catalog.listTables() if t.name == "kept_flags"]
    assert kept and not kept[0].isTemporary
    with pytest.raises(AnalysisException):
        sources.publish(df, "kept_flags", persistent=True)
    sources.publish(df, "kept_flags", persistent=True, overwrite=True)
    spark.sql("DROP TABLE kept_flags")


MIXED = {
    "1.csv": ",region,item_id,units\n0,MY,1,10\n1,MY,2,x12\n",
    "2.csv": "units,region,item_id,note\n7,SG,5,hello\n8,SG\nx,SG,y,z\n,SG,9,\n1,2,3,4,5\n",
    "3.csv": "",
    "4.csv": "units,grass_region,item_id\n3,ID,4\n",
}
UNITS = "_c0 BIGINT, region STRING, item_id BIGINT, units BIGINT"


@pytest.fixture
def mixed(tmp_path):
    folder = tmp_path / "a b%41"
    folder.mkdir()
    for name, text in MIXED.items():
        (folder / name).write_text(text)
    return str(folder)


def test_files_with_different_headers(spark, mixed):
    headers = sources.file_headers(spark, mixed)
    assert [len(files) for files in headers.values()] == [1, 1, 1]
    rows = sources.read_csv(spark, mixed, UNITS)
    got = {(r["region"], r["item_id"], r["units"], r["note"], r["_c0"]) for r in rows.collect()}
    assert {("MY", 1, 10, None, 0), ("SG", 5, 7, "hello", None), ("ID", 4, 3, None, None)} <= got
    with pytest.raises(ValueError, match="different headers"):
        sources.read_csv(spark, mixed)
    with pytest.raises(ValueError, match="has no column note"):
        sources.read_csv(spark, mixed, UNITS + ", note STRING")


def test_rejected_values_are_told(spark, mixed):
    rows = sources.read_csv(spark, mixed, UNITS, rejected="bad record")
    accepted, rejected = sources.split_rejected(rows, "bad record")
    assert "bad record" not in accepted.columns
    assert {r["item_id"]: r["units"] for r in accepted.collect()} == {1: 10, 5: 7, 9: None, 4: 3}
    told = {(r["file"][-5:], r["line"], tuple(r["columns"])) for r in rejected.collect()}
    assert told == {
        ("1.csv", "1,MY,2,x12", ("units",)), ("2.csv", "8,SG", ()), ("2.csv", "x,SG,y,z", ("units", "item_id")),
        ("2.csv", "1,2,3,4,5", ()),
    }
    with pytest.raises(ValueError, match="need a schema"):
        sources.read_csv(spark, mixed, rejected="bad")


def test_one_header_is_one_scan(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.csv").write_text(f"region,item_id,units\nMY,{i},1\n")
    rows = sources.read_csv(spark, str(tmp_path), UNITS)
    assert rows.count() == 5 and "Union" not in rows._jdf.queryExecution().executedPlan().toString()


def test_a_cluster_must_name_the_shared_folder(spark):
    from bazaarlens.sources import shared

    assert sources.new_folder(spark, "x").startswith(sources.shared_dir(spark).rstrip("/") + "/x-")
    class Unset:
        def isDefined(self):
            return False

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: Unset()})()})()

    class Session:
        conf = type("C", (), {"get": lambda self, key, default=None: None})()
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session())
