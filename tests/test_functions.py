from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from urbanflow.functions import dates as D
from urbanflow.functions import numbers as N
from urbanflow.functions import text as X
from urbanflow.functions.names import col_q


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v")).alias("o")).collect()]


def test_weekend_rule_by_occurrence(spark):
    days = ["2022-01-01", "2022-01-08", "2022-01-15", "2022-01-22", "2022-01-29", "2022-01-02", "2022-01-03", None]
    assert column(spark, days, "string", lambda c: D.weekend_rule(F.to_date(c))) == [
        False, True, False, True, False, True, False, False,
    ]


def test_minutes_of_day(spark):
    texts = ["2022-01-01T06:41:22", "06:41:22", "2022-01-01T06:41:22+05:30", "2022-01-01 00:00:30.5", "nonsense", None]
    got = column(spark, texts, "string", D.minutes_of_day)
    expected = 6 * 60 + 41 + 22 / 60
    assert got[:3] == [pytest.approx(expected, abs=1e-12)] * 3
    assert got[3] == pytest.approx(30.5 / 60, abs=1e-12)
    assert got[4:] == [None, None]


def test_dates_strict_and_lenient(spark):
    assert [str(d) for d in column(spark, ["2022-02-28", "2022-02-28 11:00:00"], "string", D.to_date_strict)] == ["2022-02-28"] * 2
    assert column(spark, ["2022-02-30", "x", None], "string", D.to_date_lenient) == [None, None, None]
    with pytest.raises(Exception, match="not a date"):
        column(spark, ["2022-02-30"], "string", D.to_date_strict)
    assert column(spark, [None], "string", D.to_date_strict) == [None]


def test_dates_strict_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a date"):
            column(spark, ["bad"], "string", D.to_date_strict)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_day_names(spark):
    assert column(spark, ["2022-01-02"], "string", lambda c: D.day_name(F.to_date(c))) == ["Sunday"]
    assert column(spark, ["Monday", "Sunday", "monday", None], "string", D.day_index) == [0, 6, None, None]
    with pytest.raises(Exception, match="unknown day name: Funday"):
        column(spark, ["Funday"], "string", D.day_index_strict)


def test_cycles(spark):
    assert column(spark, [0], "int", lambda c: D.cycle_sin(c, 7.0)) == [0.0]
    assert column(spark, [0], "int", lambda c: D.cycle_cos(c, 7.0)) == [1.0]
    # The period stays 365 in a leap year, so its last day passes the full circle.
    (leap,) = column(spark, [366], "int", lambda c: D.cycle_sin(c, 365.0))
    assert leap == pytest.approx(math.sin(2 * math.pi * 366 / 365), abs=1e-12)


def test_boolean_to_int(spark):
    texts = [" YES ", "no", "True", "1", "0", "1.0", "2", "0.5", "-1.7", "\tyes ", "maybe", None, "300", "1d", "nan"]
    assert column(spark, texts, "string", X.boolean_to_int) == [1, 0, 1, 1, 0, 1, 2, 0, -1, 1, None, None, None, None, None]
    assert column(spark, [True, False], "boolean", X.boolean_to_int) == [1, 0]
    assert column(spark, [1, 0, 7], "int", X.boolean_to_int) == [1, 0, 7]
    for bad in ("maybe", None):
        with pytest.raises(Exception, match="unexpected flag value"):
            column(spark, [bad], "string", X.boolean_to_int_strict)


def test_trim_lower_map(spark):
    got = column(spark, [" Yes\t", "NO", " yes\n", "perhaps", None], "string", lambda c: X.trim_lower_map(c, X.YES_NO))
    assert got == [True, False, True, None, None]


def test_small_helpers(spark):
    assert column(spark, [-0.0001], "double", lambda c: N.round_n(c, 3))[0].hex() == (0.0).hex()
    assert column(spark, [3.0], "double", lambda c: N.mean_of_two(c, N.scale(c, 2.0))) == [4.5]
    assert column(spark, ["a", None], "string", lambda c: X.join_text(" | ", F.lit("x"), c)) == ["x | a", "x"]
    assert column(spark, [float("nan"), None, 1.0], "double", N.present) == [False, False, True]


def test_dotted_names(spark):
    df = spark.createDataFrame([(1,)], "`Area Name_M.G. Road` int")
    assert df.select(col_q("Area Name_M.G. Road")).first()[0] == 1
