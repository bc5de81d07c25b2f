"""Daily traffic rows enriched with weather, calendar and daylight."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow import schema as S
from urbanflow.functions import dates as D
from urbanflow.functions.names import col_q
from urbanflow.functions.text import YES_NO, trim_lower_map
from urbanflow.operators.checks import require_columns
from urbanflow.operators.combine import dedup_keep_first, enrich_left_join, holiday_flag, stitch_at_cutoff
from urbanflow.operators.projection import rename_column
from urbanflow.sources.calendar import holiday_calendar
from urbanflow.sources.tables import read_table, write_table


def load_traffic(spark: SparkSession, path: str, schema=None) -> DataFrame:
    table = read_table(spark, path, schema)
    return table.withColumn(S.DATE, D.to_date_strict(col_q(S.DATE)))


def daily_weather(table: DataFrame, order: list[str]) -> DataFrame:
    """The required weather columns, one row per date: the first by `order` where a date repeats."""
    dated = table.withColumn(S.WEATHER_DATE, D.to_date_strict(col_q(S.WEATHER_DATE)))
    wanted = [S.WEATHER_DATE, *S.WEATHER_FEATURES, "sunrise", "sunset"]
    require_columns(dated, wanted)
    return require_columns(dedup_keep_first(dated, [S.WEATHER_DATE], order), wanted)


def load_weather(spark: SparkSession, path: str, order: list[str], schema=None) -> DataFrame:
    return daily_weather(read_table(spark, path, schema), order)


def stitch_weather(
    spark: SparkSession, earlier: str, later: str, out: str, cutoff: str = S.STITCH_CUTOFF, *, earlier_schema=None, later_schema=None
) -> tuple[int, int]:
    """Join two overlapping exports at the cutoff and write the result."""
    first, second = read_table(spark, earlier, earlier_schema), read_table(spark, later, later_schema)
    return write_table(stitch_at_cutoff(first, second, S.WEATHER_DATE, cutoff), out)


def enrich_rows(df: DataFrame, date: str = S.DATE) -> DataFrame:
    """The row-wise part: day name, weekend rule on top of the listed flag, roadwork flag and minutes of daylight."""
    day, roadwork = col_q(date), trim_lower_map(col_q(S.ROADWORK), YES_NO).alias(S.ROADWORK)
    return df.select(
        *[roadwork if c == S.ROADWORK else col_q(c) for c in df.columns if c != "listed"],
        D.day_name(day).alias(S.DAY_OF_WEEK),
        (F.col("listed") | D.weekend_rule(day)).alias(S.IS_HOLIDAY),
        D.daylight_minutes(F.col("sunrise"), F.col("sunset")).alias(S.DAYLIGHT),
    )


def enrich_dataset(traffic: DataFrame, weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """Traffic rows with weather, day name, holiday and roadwork flags and daylight; every row is kept.

    Both lookups are measured before they are broadcast, so the traffic side is read once and never shuffled.
    """
    joined = enrich_left_join(traffic, rename_column(weather, S.WEATHER_DATE, S.DATE), S.DATE)
    return enrich_rows(holiday_flag(joined, S.DATE, holidays, "listed"))


def run_enrichment(
    spark: SparkSession, traffic: str, weather: str, holidays: str, out: str, weather_order: list[str],
    *, traffic_schema=None, weather_schema=None,
) -> tuple[int, int]:
    """Write the enriched rows and return (rows, columns). With the schemas given, no CSV is read just to infer them."""
    enriched = enrich_dataset(
        load_traffic(spark, traffic, traffic_schema), load_weather(spark, weather, weather_order, weather_schema),
        holiday_calendar(spark, holidays),
    )
    return write_table(enriched, out)
