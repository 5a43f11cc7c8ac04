import pytest

from bazaarlens.__main__ import FLAG_VIEW, arguments, main, report

PRICING = """\
,grass_region,sku,variant,state,sold
0,ID,1,11,we win,10
1,ID,1,12,we lose,4
2,MY,2,21,we win,0
"""
PLATFORM = ",region,platform order\n0,ID,28\n"
NAMES = ["sku=item_id", "variant=model_id", "state=status", "sold=units"]


@pytest.fixture
def options(tmp_path):
    (tmp_path / "pricing.csv").write_text(PRICING)
    (tmp_path / "platform.csv").write_text(PLATFORM)
    renames = [x for n in NAMES for x in ("--rename", n)]
    return [
        "--pricing", f"{tmp_path}/pricing.csv", "--platform", f"{tmp_path}/platform.csv",
        "--cheaper", "we win", "--dearer", "we lose", *renames,
    ]


@pytest.mark.parametrize(
    ("name", "rows"),
    [
        ("scorecard", {("ID", "0.500000", "0.000000", 2), ("MY", None, None, 1)}),
        ("priority", {(1, 11, "we win"), (1, 12, "we lose"), (2, 21, "we win")}),
        ("top-items", {("ID", 1)}),
        ("flag", {("ID", 1, 11, 1), ("ID", 1, 12, 1), ("MY", 2, 21, 0)}),
    ],
)
def test_reports(spark, options, name, rows):
    assert {tuple(r) for r in report(spark, arguments([name, *options])).collect()} == rows


def test_main_prints_and_publishes(spark, options, capfd):
    main(["flag", *options, "--rows", "2"])
    assert "is_top_30_model" in capfd.readouterr().out
    assert spark.table(FLAG_VIEW).count() == 3


def test_platform_is_required_for_the_scorecard(options):
    with pytest.raises(SystemExit):
        arguments(["scorecard", "--pricing", "x.csv"])


def test_a_folder_with_rejected_lines_and_a_stored_flag(spark, options, tmp_path):
    folder = tmp_path / "folder"
    folder.mkdir()
    (folder / "a.csv").write_text(PRICING)
    (folder / "b.csv").write_text("sold,state,variant,sku,grass_region,note\n7,we win,31,3,ID,late\nx9,we win,32,3,ID,\n")
    options[1] = str(folder)
    extra = ["--rejects", f"{tmp_path}/rejects", "--table", "stored_by_command", "--buckets", "2"]
    try:
        rows = {tuple(r) for r in report(spark, arguments(["flag", *options, *extra])).collect()}
        assert rows == {("ID", 1, 11, 1), ("ID", 1, 12, 1), ("MY", 2, 21, 0), ("ID", 3, 31, 1)}
        told = spark.read.option("header", True).csv(f"{tmp_path}/rejects").collect()
        assert [(r["file"][-5:], r["line"], r["columns"]) for r in told] == [("b.csv", "x9,we win,32,3,ID,", "units")]
        buckets = spark.sql("DESCRIBE EXTENDED stored_by_command").where("col_name = 'Num Buckets'").collect()
        assert buckets[0]["data_type"] == "2"
    finally:
        spark.sql("DROP TABLE IF EXISTS stored_by_command")


def test_only_flags_are_stored(options):
    with pytest.raises(SystemExit):
        arguments(["scorecard", *options, "--table", "x"])
