"""Row numbers, attaching by position, CSV files with bad rows, and bucketed tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from urbanflow.operators import positions as P
from urbanflow.operators import search as R
from urbanflow.sources import buckets as B
from urbanflow.sources import quarantine as Q


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_numbers_without_one_task(spark):
    rng = random.Random(1)
    values = [(i, rng.choice([None, 1.5, 2.5, 7.0])) for i in range(500)]
    rows = spark.createDataFrame(values, "k int, v double")
    got = P.row_numbers(rows, [F.col("v").asc_nulls_last(), F.col("k")], "n", partitions=6)
    want = sorted(values, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    assert [tuple(r)[:2] for r in sorted(got.collect(), key=lambda r: r["n"])] == want
    assert sorted(r["n"] for r in got.collect()) == list(range(500))
    assert "SinglePartition" not in plan_of(got)
    assert P.row_numbers(rows.limit(0), ["k"], "n").count() == 0
    with pytest.raises(ValueError, match="exists"):
        P.row_numbers(rows, ["k"], "v")


def test_leaderboard_has_no_single_partition(spark):
    trials = spark.range(300).select(F.col("id").cast("int").alias("trial_id"), (F.col("id") * 37 % 101).cast("double").alias("val_rmse"))
    board = R.trial_leaderboard(trials)
    rows = [(r["val_rmse"], r["trial_id"]) for r in sorted(board.collect(), key=lambda r: r["rank"])]
    assert rows == sorted(rows) and len(rows) == 300
    assert "SinglePartition" not in plan_of(board)


def test_files_are_numbered_as_they_stand(spark, tmp_path, monkeypatch):
    path = tmp_path / "long.csv"
    path.write_text("x,y\n" + "".join(f"{i},{'z' * (i % 50)}\n" for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        placed = P.file_positions(spark, str(path), "x int, y string")
        assert placed.rdd.getNumPartitions() >= 1
        assert placed.where("x <> position").count() == 0 and placed.count() == 4000
        spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "parts"))
        assert P.file_positions(spark, str(tmp_path / "parts")).where("id <> position").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    dates = tmp_path / "dates.csv"
    dates.write_text("d\n" + "".join(f"2022-01-{i % 28 + 1:02d}\n" for i in range(4000)))
    both = P.positional_attach(placed, P.file_positions(spark, str(dates), "d date"))
    assert both.columns == ["position", "x", "y", "d"]
    assert both.where("day(d) <> x % 28 + 1").count() == 0 and both.count() == 4000
    with pytest.raises(ValueError, match="4000 and 3999 rows"):
        P.positional_attach(placed, P.file_positions(spark, str(dates), "d date").where("position < 3999"))
    with pytest.raises(ValueError, match="in both"):
        P.positional_attach(placed, placed)


def test_bad_records_are_kept_apart(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text('k,price,day,note\n1,2.5,2022-01-01,"a, b"\n2,oops,2022-01-02,x\n3,1,2022-13-01,x\n4,7\n5,NaN,2022-01-03,x\n6,1,2022-01-04,x,more\n')
    schema, rejects = "k int, price double, day date, note string", str(tmp_path / "rejects")
    with pytest.raises(ValueError, match="4 records .* cannot be read"):
        Q.read_quarantined(spark, str(path), schema)
    rows, count = Q.read_quarantined(spark, str(path), schema, rejects)
    assert sorted((r["k"], r["price"], r["note"]) for r in rows.collect()) == [(1, 2.5, "a, b"), (5, None, "x")] and count == 4
    found = {r["record"][0]: r for r in spark.read.parquet(rejects).collect()}
    assert {k: r["reason"] for k, r in found.items()} == {
        "2": "price: oops is no double", "3": "day: 2022-13-01 is no date", "4": "fewer than 4 values", "6": "more than 4 values"}
    assert all(r["file"].endswith("bad.csv") for r in found.values())
    clean = tmp_path / "clean.csv"
    clean.write_text("k\n1\n")
    assert Q.read_quarantined(spark, str(clean), "k int")[1] == 0
    with pytest.raises(FileNotFoundError):
        Q.read_quarantined(spark, str(tmp_path / "absent.csv"), "k int")


def test_bucketed_tables_join_and_group_without_a_shuffle(spark):
    left = spark.range(5000).select((F.col("id") % 400).alias("d"), F.col("id").alias("v"))
    right = spark.range(400).select(F.col("id").alias("d"), (F.col("id") * 2).alias("w"))
    try:
        a, b = B.write_bucketed(left, "days_left", ["d"], 8), B.write_bucketed(right, "days_right", ["d"], 8)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = a.join(b, "d")
        assert joined.count() == 5000 and "Exchange hashpartitioning" not in plan_of(joined)
        grouped = a.groupBy("d").agg(F.max("v"))
        assert grouped.count() == 400 and "Exchange hashpartitioning" not in plan_of(grouped)
        B.write_bucketed(left.where("v < 10"), "days_left", ["d"], 8)
        assert spark.table("days_left").count() == 10 and len(B.versions(spark, "days_left")) == 1
        with pytest.raises(Exception, match="lost"):
            B.write_bucketed(left.withColumn("v", F.raise_error(F.lit("lost")).cast("long")), "days_left", ["d"], 8)
        assert spark.table("days_left").count() == 10 and len(B.versions(spark, "days_left")) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("days_left", "days_right"):
            B.drop_bucketed(spark, name)
