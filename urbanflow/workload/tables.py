"""Traffic-like views of the driver tables, each next to the SQL that defines the same view.

Orders play the traffic rows (date, area = region, road = nation, volume = price), lineitems grouped by ship date play
the daily weather, and the large urgent orders of a month play the holiday list. Joins carry no hint: nation, region
and, while it is small, customer are broadcast by Spark from their file sizes; a large customer table is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow import schema as S
from urbanflow.sources.tables import read_table

# Years of the model split in the driver tables; the other years show that rows fall out.
YEARS = {"train": 1998, "val": 1999, "test": 2000}

# Declared, so that no job is spent on finding them out.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet", SCHEMAS[name], "parquet")


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Customer key with area and road."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name", "n_name")
    joined = customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", F.col("r_name").alias("area"), F.col("n_name").alias("road"))


def facts(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    joined = orders.join(places(spark, sf), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("d"), "area", "road",
        F.col("o_totalprice").alias("volume"), F.col("o_orderpriority").alias("weather"),
        F.col("o_orderstatus").alias("roadwork"),
    )


FACTS = """facts AS (
  SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, r_name AS area, n_name AS road, o_totalprice AS volume,
         o_orderpriority AS weather, o_orderstatus AS roadwork
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)"""

# The measurements of an order: (column, SQL over its lineitems that both engines read). Nine digits keep every
# exact value and drop the last bits, which depend on the order of a sum.
ORDER_MEASURES = [
    ("Average Speed", "avg(l_quantity)"),
    ("Travel Time Index", "round(1 + 8 * avg(l_tax), 9)"),
    ("Congestion Level", "round(1000 * avg(l_discount), 9)"),
    ("Road Capacity Utilization", "round(avg(l_extendedprice) / 1000, 9)"),
    ("Incident Reports", "count(CASE WHEN l_returnflag = 'R' THEN 1 END)"),
    ("Environmental Impact", "sum(l_quantity)"),
    ("Public Transport Usage", "max(l_quantity)"),
    ("Traffic Signal Compliance", "min(l_quantity)"),
    ("Parking Usage", "round(100 * sum(l_discount), 9)"),
    ("Pedestrian and Cyclist Count", "count(*)"),
]
COUNTS = ("Incident Reports", "Pedestrian and Cyclist Count")
WEATHER_CASE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Rain' WHEN '2-HIGH' THEN 'Fog' WHEN '3-MEDIUM' THEN 'Clear'
       WHEN '4-NOT SPECIFIED' THEN 'Windy' ELSE 'Overcast' END"""
ROADWORK_CASE = "CASE o_orderstatus WHEN 'F' THEN ' Yes ' WHEN 'O' THEN 'no' ELSE 'NO' END"


def traffic(spark: SparkSession, sf: str) -> DataFrame:
    """All orders, as traffic rows with the column names of the data files and the key `k`.

    An order without lineitems has the counts 0 and no other measurements.
    """
    lines = table(spark, sf, "lineitem")
    measures = lines.groupBy("l_orderkey").agg(*[F.expr(e).alias(c) for c, e in ORDER_MEASURES])
    orders = table(spark, sf, "orders").join(measures, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    joined = orders.join(places(spark, sf), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias(S.DATE), F.col("area").alias(S.AREA),
        F.col("road").alias(S.ROAD), F.col("o_totalprice").alias(S.VOLUME),
        *[F.coalesce(c, F.lit(0)).alias(c) if c in COUNTS else F.col(c) for c, _ in ORDER_MEASURES],
        F.expr(WEATHER_CASE).alias(S.WEATHER), F.expr(ROADWORK_CASE).alias(S.ROADWORK),
    )


TRAFFIC = f"""traffic AS (
  SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS "Date", r_name AS "Area Name",
         n_name AS "Road/Intersection Name", o_totalprice AS "Traffic Volume",
         {", ".join(f'coalesce(m."{c}", 0) AS "{c}"' if c in COUNTS else f'm."{c}"' for c, _ in ORDER_MEASURES)},
         {WEATHER_CASE} AS "Weather Conditions", {ROADWORK_CASE} AS "Roadwork and Construction Activity"
  FROM orders LEFT JOIN (SELECT l_orderkey,{", ".join(f'{e} AS "{c}"' for c, e in ORDER_MEASURES)}
                    FROM lineitem GROUP BY l_orderkey) m ON o_orderkey = l_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)"""

# The weather columns of a ship date: (column, SQL over its lineitems that both engines read).
DAY_MEASURES = [
    ("tempmax", "max(l_quantity)"),
    ("tempmin", "min(l_quantity)"),
    ("feelslikemax", "max(l_extendedprice)"),
    ("feelslikemin", "min(l_extendedprice)"),
    ("dew", "max(l_tax)"),
    ("humidity", "max(l_discount)"),
    ("precip", "min(l_discount)"),
    ("precipcover", "min(l_tax)"),
    ("windgust", "max(l_quantity * l_discount)"),
    ("windspeed", "min(l_quantity * l_discount)"),
    ("winddir", "CAST(max(l_suppkey) AS DOUBLE)"),
    ("cloudcover", "CAST(count(*) AS DOUBLE)"),
    ("visibility", "CAST(max(l_linenumber) AS DOUBLE)"),
    ("solarradiation", "CAST(max(l_partkey) AS DOUBLE)"),
    ("uvindex", "CAST(min(l_linenumber) AS DOUBLE)"),
    ("sunrise", "concat('2022-01-01T06:', lpad(CAST(CAST(min(l_quantity) AS INT) AS STRING), 2, '0'), ':', "
                "lpad(CAST(count(*) % 60 AS STRING), 2, '0'))"),
    ("sunset", "concat('18:', lpad(CAST(CAST(max(l_quantity) AS INT) AS STRING), 2, '0'), ':', "
               "lpad(CAST(max(l_linenumber) AS STRING), 2, '0'))"),
]


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """One row per ship date; the number of rows is bounded by the calendar, not by the data."""
    lines = table(spark, sf, "lineitem")
    daily = lines.groupBy(F.to_date("l_shipdate").alias(S.WEATHER_DATE))
    return daily.agg(*[F.expr(e).alias(c) for c, e in DAY_MEASURES])


WEATHER = f"""weather AS (
  SELECT CAST(l_shipdate AS DATE) AS "datetime", {", ".join(f"{e} AS {c}" for c, e in DAY_MEASURES)}
  FROM lineitem GROUP BY 1)"""

# Large urgent orders mark the days that the calendar lists.
LISTED = "o_orderpriority = '1-URGENT' AND o_totalprice > 480000"


def calendar_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar text made of the listed days: per year a heading, an ignored heading and a line per month.

    A day list has at most 31 entries, whatever the number of orders.
    """
    days = table(spark, sf, "orders").where(LISTED).select(
        F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("day")
    ).distinct()
    month_name = F.date_format(F.make_date("y", "m", F.lit(1)), "MMMM")
    entries = days.groupBy("y", "m").agg(F.array_join(F.array_sort(F.collect_set("day")), ", ").alias("list"))
    months = entries.select(
        "y", F.col("m").alias("pos"), F.concat(month_name, F.lit(" - "), F.col("list"), F.lit(", x,")).alias("line")
    )
    years = days.select("y").distinct()
    heads = years.select("y", F.explode(F.array(
        F.struct(F.lit(-1).alias("pos"), F.concat(F.lit("## "), F.col("y").cast("string")).alias("line")),
        F.struct(F.lit(0).alias("pos"), F.lit("# Notes").alias("line")),
    )).alias("h")).select("y", "h.pos", "h.line")
    return months.unionByName(heads).select(
        F.lit("calendar").alias("doc"), F.col("y").cast("long").alias("block"), "pos", "line"
    )


HOLIDAYS = f"""holidays AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS holiday_date FROM orders WHERE {LISTED})"""

# Weekend rule and calendar flag in ANSI SQL, over a date column.
WEEKEND = """(isodow({d}) = 7 OR (isodow({d}) = 6 AND (day({d}) - 1) // 7 + 1 IN (2, 4)))"""
MINUTES = "(hour({t}) * 60 + minute({t}) + date_part('microsecond', {t}) / 6e7)"
DAY_NAMES = "(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'])[isodow({d})]"
DAYLIGHT = f"({MINUTES.format(t='CAST(sunset AS TIME)')} - {MINUTES.format(t='CAST(sunrise AS TIMESTAMP)')})"

ENRICHED = f"""{TRAFFIC}, {WEATHER}, {HOLIDAYS}, enriched AS (
  SELECT t.* EXCLUDE ("Roadwork and Construction Activity"), w.* EXCLUDE ("datetime"),
         {DAY_NAMES.format(d='t."Date"')} AS day_of_week,
         (h.holiday_date IS NOT NULL OR {WEEKEND.format(d='t."Date"')}) AS is_holiday,
         CASE lower(trim("Roadwork and Construction Activity")) WHEN 'yes' THEN true WHEN 'no' THEN false END
           AS "Roadwork and Construction Activity",
         {DAYLIGHT} AS minutes_of_daylight
  FROM traffic t LEFT JOIN weather w ON t."Date" = w."datetime" LEFT JOIN holidays h ON t."Date" = h.holiday_date)"""
