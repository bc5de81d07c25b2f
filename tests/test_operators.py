from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from urbanflow.operators import aggregates as A
from urbanflow.operators import checks as K
from urbanflow.operators import combine as C
from urbanflow.operators import encode as E
from urbanflow.operators import projection as P
from urbanflow.operators import rules as R
from urbanflow import session
from urbanflow.session import join_lookup


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def day(text):
    return dt.date.fromisoformat(text) if text else None


# checks and projections


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert K.require_columns(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        K.require_columns(df, ["x", "a", "y"])


def test_check_numeric_names_flags_and_texts(spark):
    df = spark.createDataFrame([(1, True, "t", 1.0)], "n int, flag boolean, text string, d double")
    with pytest.raises(ValueError, match=r"\['flag', 'text'\]"):
        K.check_numeric(df)
    assert K.check_numeric(df.select("n", "d")).columns == ["n", "d"]


def test_check_values_and_dates(spark):
    df = spark.createDataFrame([("2022-01-01",), ("13/13/13",), (None,)], "d string")
    with pytest.raises(ValueError, match="13/13/13"):
        K.check_dates(df, "d")
    good = df.where("d = '2022-01-01'")
    assert K.check_dates(good, "d") is good


def test_selection_orders(spark):
    names = ["Area Name_B", "extra", "is_holiday", "day_of_week_cos", "Average Speed", "Area Name_A", "Traffic Volume", "Weather Conditions_Rain"]
    df = spark.createDataFrame([tuple(range(8))], ", ".join(f"`{n}` int" for n in names))
    assert P.select_allowlist_ordered(df).columns == [
        "Traffic Volume", "Average Speed", "day_of_week_cos", "Weather Conditions_Rain", "Area Name_B", "Area Name_A",
    ]
    kept, missing = P.select_allowlist_stable(df)
    assert kept.columns == [n for n in names if n != "extra"]
    assert missing == sorted(set(P.S.DIRECT_FEATURES) - {"Traffic Volume", "Average Speed"})
    with pytest.raises(ValueError, match="none of the wanted"):
        P.select_allowlist_ordered(df.select("extra", "is_holiday"))
    assert P.select_allowlist_stable(df.select("extra"))[0].columns == []
    assert P.select_excluding_substring(df, ["Name_", "day_of"]).columns == [
        "extra", "is_holiday", "Average Speed", "Traffic Volume", "Weather Conditions_Rain",
    ]


def test_drop_columns_and_feature_target(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, `b.c` int, y int")
    assert P.drop_columns(df, ["b.c"]).columns == ["a", "y"]
    with pytest.raises(ValueError, match="zzz"):
        P.drop_columns(df, ["zzz"])
    x, y = P.feature_target_split(df, "y")
    assert (x.columns, y.columns) == (["a", "b.c"], ["y"])


def test_filter_before_cutoff(spark):
    df = spark.createDataFrame([("2023-06-30",), ("2023-07-01",), (None,)], "d string")
    assert rows(P.filter_before_cutoff(df, "d", "2023-07-01")) == [("2023-06-30",)]
    with pytest.raises(Exception, match="not a date"):
        P.filter_before_cutoff(spark.createDataFrame([("bad",)], "d string"), "d", "2023-07-01").collect()


def test_split_by_year_is_pushed_down_and_disjoint(spark):
    days = ["2021-12-31", "2022-01-01", "2022-12-31", "2023-05-05", "2024-12-31", "2025-01-01", None]
    df = spark.createDataFrame([(day(d),) for d in days], "d date")
    got = rows(P.split_by_year(df, "d").orderBy("d"), "split")
    assert got == [("train",), ("train",), ("val",), ("test",)]
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = P.split_by_year(orders, "o_orderdate", {"train": 1998})._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


# joins, dedup, unions


@pytest.mark.parametrize("max_bytes", [0, 10**9])
def test_enrich_left_join_keeps_rows(spark, monkeypatch, max_bytes):
    monkeypatch.setattr(session.join_lookup, "__defaults__", ("left", max_bytes))
    facts = spark.createDataFrame([(1, day("2022-01-01")), (2, day("2022-01-02")), (3, None)], "k int, d date")
    daily = spark.createDataFrame([(day("2022-01-01"), 5.0), (None, 9.0)], "d date, t double")
    got = sorted(rows(C.enrich_left_join(facts, daily, "d"), "k", "t"))
    assert got == [(1, 5.0), (2, None), (3, None)]
    with pytest.raises(ValueError, match=r"\['k'\]"):
        C.enrich_left_join(facts, daily.withColumn("k", F.lit(1)), "d")


def test_join_lookup_measures_before_it_broadcasts(spark):
    left = spark.range(1000).withColumnRenamed("id", "k")
    right = spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 100).alias("t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = join_lookup(left, right, ["k"], "left", 1000)._jdf.queryExecution().executedPlan().toString()
        small = join_lookup(left, right, ["k"], "left", 100_000)._jdf.queryExecution().executedPlan().toString()
        nested = join_lookup(left, right.withColumn("a", F.array("t")), ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in big and "BroadcastHashJoin" in small and "SortMergeJoin" in nested


def test_holiday_flag_repeats_no_row(spark):
    df = spark.createDataFrame([(day("2022-01-01"),), (day("2022-01-02"),), (None,)], "d date")
    listed = spark.createDataFrame([(day("2022-01-01"),)] * 3 + [(None,)], "h date")
    assert sorted(rows(C.holiday_flag(df, "d", listed)), key=str) == [
        (None, False), (day("2022-01-01"), True), (day("2022-01-02"), False),
    ]


@pytest.mark.parametrize("partitions", [1, 8])
def test_dedup_keep_first(spark, partitions):
    data = [(day("2022-01-01"), 2, "second"), (day("2022-01-01"), 1, "first"), (None, 4, "x"), (None, 3, "y")]
    df = spark.createDataFrame(data, "d date, o int, t string").repartition(partitions)
    assert sorted(rows(C.dedup_keep_first(df, ["d"], ["o"]), "t")) == [("first",), ("y",)]
    plan = C.dedup_keep_first(df, ["d"], ["o"])._jdf.queryExecution().executedPlan().toString()
    # Where rows are shuffled, a hot key is cut down before the shuffle as well.
    assert plan.count("WindowGroupLimit") == (2 if partitions > 1 else 1)


def test_stitch_at_cutoff(spark):
    a = spark.createDataFrame([("2023-06-30", 1), ("2023-07-01", 2), (None, 3)], "d string, x int")
    b = spark.createDataFrame([("2023-01-01", 4, "e")], "d string, x int, extra string")
    got = sorted(rows(C.stitch_at_cutoff(a, b, "d", "2023-07-01")))
    assert got == [("2023-01-01", 4, "e"), ("2023-06-30", 1, None)]


def test_attach_by_key_is_a_left_join(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a", 0), (3, "c", 0)], "k int, d string, z int")
    assert sorted(rows(C.attach_by_key(left, right, "k", ["d"]))) == [(1, "a"), (2, None)]


# aggregates


def test_group_sums_drop_missing_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), (None, 5.0)], "k string, v double")
    assert rows(A.group_sum(df, ["k"], "v")) == [("a", 1.0), ("b", 0.0)]
    assert rows(A.group_mean(df, ["k"], "v")) == [("a", 1.0), ("b", None)]
    assert rows(A.share_of_total(df, "k", "v")) == [("a", 1.0, 100.0), ("b", 0.0, 0.0)]
    assert rows(A.ratio_to_max(df, "k", "v")) == [("a", 1.0, 1.0), ("b", None, None)]


MODES = [("a", "z"), ("a", "b"), ("b", None), ("b", None), ("b", "q"), ("c", None), ("d", "y"), ("d", "y"), ("d", "a"), (None, "n")]


@pytest.mark.parametrize("partitions", [1, 6])
def test_modes(spark, partitions):
    df = spark.createDataFrame(MODES, "k string, v string").repartition(partitions)
    expected = [("a", "b"), ("b", "q"), ("c", None), ("d", "y")]
    assert sorted(rows(A.group_mode(df, ["k"], "v"))) == expected
    twice = df.withColumn("w", F.upper("v")).withColumn("n", F.lit(1))
    got = rows(A.mixed_profile(twice, ["k"], ["n"], [], ["v", "w"]))
    assert got == [(k, 1.0, v, v and v.upper()) for k, v in expected]


def test_mixed_profile(spark):
    data = [("a", 1.0, 2, "x", "no"), ("a", None, None, "y", "no"), ("a", 4.0, 3, "y", None), ("b", None, None, None, None)]
    df = spark.createDataFrame(data, "k string, m double, s int, w string, r string")
    assert rows(A.mixed_profile(df, ["k"], ["m"], ["s"], ["w", "r"])) == [("a", 2.5, 5, "y", "no"), ("b", None, 0, None, None)]


def test_pivots(spark):
    data = [("a", "M.G. Road", 1), ("a", "M.G. Road", 2), ("b", "x", None), (None, "x", 9), ("a", None, 9)]
    df = spark.createDataFrame(data, "area string, `road/name` string, v int")
    matrix = A.pivot_sum(df, "area", "road/name", "v")
    assert matrix.columns == ["area", "M.G. Road", "x"]
    assert rows(matrix) == [("a", 3, None), ("b", None, 0)]
    assert rows(A.pivot_sum(df, "area", "road/name", "v", fill=0)) == [("a", 3, 0), ("b", 0, 0)]
    with pytest.raises(ValueError, match="too many distinct values"):
        A.level_values(spark.range(20), ["id"], 10)


def test_year_counts_and_shape(spark):
    df = spark.createDataFrame([(day("2023-01-01"),), (day("2022-01-01"),), (day("2023-02-01"),), (None,)], "d date")
    assert rows(A.year_counts(df, "d")) == [(2022, 1), (2023, 2)]
    assert rows(A.shape(df)) == [(4, 1)]


# encoding and rules


def test_one_hot(spark):
    data = [(1, "M.G. Road", "r/1"), (2, None, "r/2"), (3, "Bank", "r/1")]
    df = spark.createDataFrame(data, "k int, `Area Name` string, `Road/Intersection Name` string")
    wide = E.one_hot(df, ["Area Name", "Road/Intersection Name"])
    assert wide.columns == ["k", "Area Name_Bank", "Area Name_M.G. Road", "Road/Intersection Name_r/1", "Road/Intersection Name_r/2"]
    assert sorted(rows(wide)) == [(1, 0, 1, 1, 0), (2, 0, 0, 0, 1), (3, 1, 0, 1, 0)]


ENCODE_SCHEMA = "Date string, v int, day_of_week string, `Weather Conditions` string, `Area Name` string, `Road/Intersection Name` string, is_holiday boolean, `Roadwork and Construction Activity` boolean, sunrise string"


def test_encode_dataset_order_and_guards(spark):
    good = [("2024-12-31", 5, "Tuesday", "Rain", "A", "R", True, False, "06:00")]
    df = spark.createDataFrame(good, ENCODE_SCHEMA)
    with pytest.raises(ValueError, match="sunrise"):
        E.encode_dataset(df)
    table = E.encode_dataset(df, drop=("sunrise",), passthrough=("Date",))
    assert table.columns == [
        "Date", "v", "is_holiday", "Roadwork and Construction Activity", "day_of_week_sin", "day_of_week_cos",
        "day_of_year_sin", "day_of_year_cos", "Weather Conditions_Rain", "Area Name_A", "Road/Intersection Name_R",
    ]
    row = table.first()
    assert (row["is_holiday"], row["Roadwork and Construction Activity"]) == (1, 0)
    assert row["day_of_week_sin"] ** 2 + row["day_of_week_cos"] ** 2 == pytest.approx(1)
    for position, bad, message in ((0, "x", "cannot be parsed"), (2, "Funday", "unknown day"), (7, None, "unexpected flag")):
        broken = [tuple(bad if i == position else v for i, v in enumerate(good[0]))]
        with pytest.raises(Exception, match=message):
            E.encode_dataset(spark.createDataFrame(broken, ENCODE_SCHEMA), drop=("sunrise",)).collect()


@pytest.mark.parametrize(
    "congestion, word",
    [(75.0, "low"), (75.01, "high"), (50.0, "low"), (50.01, "moderate"), (None, "low"), (float("nan"), "low")],
)
def test_advisory_boundaries(spark, congestion, word):
    schema = "`Congestion Level` double, `Incident Reports` int, `Environmental Impact` double, `Average Speed` double, `Travel Time Index` double, `Weather Conditions` string"
    df = spark.createDataFrame([(congestion, 6, 151.0, 40.0, 1.3, "Windy")], schema)
    parts = R.advisory_rules(df).first()["Overall Advisory"].split(" | ")
    assert parts[0].startswith(f"Congestion {word}")
    assert len(parts) == 5  # an unlisted weather adds no text
    assert parts[1].startswith("Incidents occasional") and parts[2].startswith("Emissions high") and parts[3] == "Speed high"
    assert parts[4] == "Trips take the usual time"
    with_rain = R.advisory_rules(df.withColumn("Weather Conditions", F.lit("Rain"))).first()["Overall Advisory"]
    assert with_rain.endswith(" | Wet roads: drive with care")


def test_enrich_left_join_refuses_repeated_keys(spark):
    facts = spark.createDataFrame([(1, "a")], "k int, d string")
    with pytest.raises(ValueError, match="repeats the key"):
        C.enrich_left_join(facts, spark.createDataFrame([("a", 1), ("a", 2)], "d string, t int"), "d")
    missing = spark.createDataFrame([(None, 1), (None, 2)], "d string, t int")
    assert C.enrich_left_join(facts, missing, "d").count() == 1


def test_standardize_ignores_nan(spark):
    from urbanflow.operators.reduce import standardize

    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "v double")
    assert sorted(r.v for r in standardize(df, ["v"]).where("v IS NOT NULL").collect()) == [-1.0, 1.0]


def test_check_values_counts_all_bad_values(spark):
    from urbanflow.operators.checks import check_values

    df = spark.range(1025).select(F.col("id").cast("string").alias("v"))
    with pytest.raises(ValueError, match="1025 in all"):
        check_values(df, "v", F.lit(None).cast("int"))


def test_watched_values_are_counted_by_the_job_itself(spark):
    from urbanflow.functions.text import boolean_to_int
    from urbanflow.operators.checks import Watch

    df = spark.createDataFrame([(i, f"bad {i % 30}" if i % 2 else "yes", None if i == 8 else "1") for i in range(200)], "k int, a string, b string")
    watch = Watch(df, {c: boolean_to_int(F.col(c)) for c in ("a", "b")})
    assert watch.table.where("k >= 0").count() == 200
    assert watch.counts() == {"a": 100, "b": 1}
    with pytest.raises(ValueError) as error:
        watch.verify()
    assert all(f"'bad {i}'" in str(error.value) for i in range(1, 30, 2)) and "b: [None] in 1 rows" in str(error.value)
    fine = Watch(df.where("k % 2 = 0 AND k <> 8"), {"a": boolean_to_int(F.col("a"))})
    fine.table.collect()
    fine.verify()


def test_encoding_job_lists_all_bad_values_and_keeps_the_old_table(spark, tmp_path):
    from urbanflow.plans.encoding import run_encoding
    from urbanflow.sources.tables import read_table

    good = ("2024-12-31", 5, "Tuesday", "Rain", "A", "R", "yes", "no", "06:00")
    schema = ENCODE_SCHEMA.replace("boolean", "string")
    out, source = str(tmp_path / "encoded"), str(tmp_path / "enriched")
    spark.createDataFrame([good] * 3, schema).write.parquet(source)
    assert run_encoding(spark, source, out) == (3, 10)
    bad = [good, ("nonsense", *good[1:]), (None, *good[1:]), (*good[:2], "Funday", *good[3:]), (*good[:2], "Moonday", *good[3:]), (*good[:6], "perhaps", *good[7:])]
    spark.createDataFrame(bad, schema).write.mode("overwrite").parquet(source)
    with pytest.raises(ValueError) as error:
        run_encoding(spark, source, out)
    for word in ("Date: [None, 'nonsense'] in 2 rows", "day_of_week: ['Funday', 'Moonday'] in 2 rows", "is_holiday: ['perhaps'] in 1 rows"):
        assert word in str(error.value)
    assert read_table(spark, out).count() == 3 and [p.name for p in tmp_path.iterdir() if "encoded." in p.name] == []


def test_sparse_levels_are_those_of_the_columns(spark):
    df = spark.createDataFrame([(1, "b", "x"), (2, None, "y"), (3, "a", None), (4, "c", "x")], "k int, u string, w string")
    index = E.level_index(df, ["u", "w"])
    assert sorted(tuple(r) for r in index.collect()) == [("u", "a", 0, 3), ("u", "b", 1, 3), ("u", "c", 2, 3), ("w", "x", 0, 2), ("w", "y", 1, 2)]
    wide = {r["k"]: list(r)[1:] for r in E.one_hot(df, ["u", "w"]).collect()}
    sparse = E.one_hot_sparse(df, ["u", "w"], index)
    assert sparse.columns == ["k", "levels"]
    assert {r["k"]: r["levels"].toArray().tolist() for r in sparse.collect()} == wide
    unseen = spark.createDataFrame([(9, "new", "y")], "k int, u string, w string")
    assert E.one_hot_sparse(unseen, ["u", "w"], index).first()["levels"].toArray().tolist() == [0, 0, 0, 0, 1]


def test_a_hundred_thousand_levels_are_one_column(spark):
    df = spark.range(100_000).select("id", F.concat(F.lit("level "), F.col("id").cast("string")).alias("u"), (F.col("id") % 3).cast("string").alias("w"))
    sparse = E.one_hot_sparse(df, ["u", "w"], E.level_index(df, ["u", "w"]))
    assert sparse.columns == ["id", "levels"]
    row = sparse.where("id = 77").first()["levels"]
    assert row.size == 100_003 and row.numNonzeros() == 2 and len(row.indices) == 2
    assert sparse.count() == 100_000
