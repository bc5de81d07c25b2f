from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from urbanflow.sources import calendar as C
from urbanflow.sources import tables as IO


def test_csv_round_trip_counts_rows(spark, tmp_path):
    path = str(tmp_path / "nested" / "nation.csv")
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    assert IO.write_table(nation, path) == (25, 3)
    back = IO.read_table(spark, path, nation.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, nation.collect()))
    assert IO.read_table(spark, path).schema["n_nationkey"].dataType.simpleString() == "int"
    assert IO.write_table(nation.limit(3), path) == (3, 3)
    assert IO.read_table(spark, path, nation.schema).count() == 3


def test_csv_nan_is_missing_and_bad_numbers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1.5,a\nNaN,b\n")
    assert [r["x"] for r in IO.read_table(spark, str(tmp_path / "a.csv"), "x double, y string").collect()] == [1.5, None]
    (tmp_path / "b.csv").write_text("x\n1\noops\n")
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        IO.read_table(spark, str(tmp_path / "b.csv"), "x int").collect()


def test_scan_pruned_reaches_the_reader(spark):
    df = IO.scan_pruned(spark, "/root/testdata/sf0.001/lineitem.parquet", ["l_tax"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_tax:double>" in plan
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        IO.scan_pruned(spark, "/root/testdata/sf0.001/lineitem.parquet", ["absent"])


def test_missing_path(spark):
    with pytest.raises(FileNotFoundError, match="absent"):
        IO.require_path(spark, "/tmp/absent-for-sure")
    with pytest.raises(FileNotFoundError):
        IO.read_table(spark, "/tmp/absent-for-sure.csv", "x int")


def test_report_lines(spark, tmp_path):
    df = spark.createDataFrame([("North", "M.G. Road", "slow")], "a string, r string, t string")
    lines = IO.report_lines(df, [("Area", "a"), ("Street", "r"), ("Advisory", "t")])
    assert lines.first()[0] == "Area: North, Street: M.G. Road, Advisory: slow"
    IO.write_lines(lines, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 1


CALENDAR = """Jan - 9
# 2022
## Notes
no dash here
Foo - 3
Jan - 1,,x, 14
March - 8
March - 8

  ##  2023
sept-  5 , +6, 1_2
Dec - 1 - 2, 4
"""


def dates(df):
    return sorted(r["holiday_date"].isoformat() for r in df.collect())


def test_calendar_grammar(spark, tmp_path):
    (tmp_path / "a.md").write_text(CALENDAR)
    # The year of one file never reaches the next.
    (tmp_path / "b.md").write_text("Feb - 2\n# 2024\nFeb - 29\n")
    got = dates(C.holiday_calendar(spark, str(tmp_path)))
    assert got == ["2022-01-01", "2022-01-14", "2022-03-08", "2023-09-05", "2023-09-06", "2023-09-12", "2023-12-04", "2024-02-29"]


def test_calendar_impossible_date(spark, tmp_path):
    (tmp_path / "a.md").write_text("# 2022\nFeb - 30, 2\n")
    with pytest.raises(Exception, match="impossible date: 2022-02-30"):
        C.holiday_calendar(spark, str(tmp_path)).collect()
    lines = C.read_lines(spark, str(tmp_path))
    assert dates(C.sectioned_dates(lines, "doc", "block", "pos", "line", lenient=True)) == ["2022-02-02"]


def test_calendar_file_split_among_tasks(spark, tmp_path):
    """A heading reaches the lines of later splits of the same file."""
    months = ["Jan - 1, 2", "Feb - 3", "Mar - 4", "filler without a day " * 20]
    text = "".join(f"# {year}\n" + "\n".join(months * 10) + "\n" for year in range(1990, 2020))
    (tmp_path / "long.md").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = C.read_lines(spark, str(tmp_path / "long.md"))
        assert lines.select("block").distinct().count() > 20
        got = dates(C.sectioned_dates(lines, "doc", "block", "pos", "line"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = [dt.date(y, m, d).isoformat() for y in range(1990, 2020) for m, d in ((1, 1), (1, 2), (2, 3), (3, 4))]
    assert got == sorted(expected)


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_carry_forward_matches_one_window(spark, block_rows):
    rows = [(f"d{i % 3}", i, i * 7 % 5 if i % 4 == 0 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "doc string, pos int, v int").withColumn("block", F.floor(F.col("pos") / block_rows))
    got = {(r["doc"], r["pos"]): r["f"] for r in C.carry_forward(df.repartition(5), ["doc"], "block", "pos", "v", "f").collect()}
    last, expected = {}, {}
    for doc, pos, value in rows:
        last[doc] = value if value is not None else last.get(doc)
        expected[doc, pos] = last[doc]
    assert got == expected


def test_explode_lines_numbers_every_line(spark):
    df = spark.createDataFrame([("a", "x\ny\r\nz"), ("b", "")], "id string, t string")
    got = sorted((r["doc"], r["pos"], r["line"]) for r in C.explode_lines(df, "id", "t").collect())
    assert got == [("a", 0, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 0, "")]
