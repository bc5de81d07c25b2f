"""Queries of the scalar functions, the encoders, the enrichment and the rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanflow import schema as S
from urbanflow.functions import dates as D
from urbanflow.functions import numbers as N
from urbanflow.functions import text as X
from urbanflow.operators import encode as E
from urbanflow.operators import projection as P
from urbanflow.operators.aggregates import level_values
from urbanflow.operators.reduce import standardize
from urbanflow.operators.rules import advisory_rules
from urbanflow.plans.enrichment import daily_weather, enrich_dataset
from urbanflow.plans.exploration import area_road_advisories, area_road_profile
from urbanflow.sources.calendar import sectioned_dates
from urbanflow.sources.tables import report_lines
from urbanflow.workload import tables as T
from urbanflow.workload.registry import query
from urbanflow.workload.rows import dummies_sql
from urbanflow.workload.stats import AREAS, NATIONS, mode_sql, rounded


def _orders(spark, sf):
    return T.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))


DATED = "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"


@query("to_date_strict", f"SELECT o_orderkey, d FROM {DATED}")
def _(spark, sf):
    text = T.table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("t"))
    return text.select("o_orderkey", D.to_date_strict(F.col("t")).alias("d"))


@query(
    "to_date_lenient",
    f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE d END AS d FROM {DATED}",
)
def _(spark, sf):
    broken = F.when(F.col("o_orderkey") % 3 == 0, F.lit("not a date")).otherwise(F.col("d").cast("string"))
    return _orders(spark, sf).select("o_orderkey", D.to_date_lenient(broken).alias("d"))


@query("day_name", f"SELECT o_orderkey, dayname(d) AS day_of_week FROM {DATED}")
def _(spark, sf):
    return _orders(spark, sf).select("o_orderkey", D.day_name(F.col("d")).alias("day_of_week"))


@query("day_index", f"SELECT o_orderkey, CAST(isodow(d) - 1 AS INTEGER) AS day FROM {DATED}")
def _(spark, sf):
    return _orders(spark, sf).select("o_orderkey", D.day_index(D.day_name(F.col("d"))).alias("day"))


@query(
    "calendar_parts",
    f"SELECT o_orderkey, CAST(year(d) AS INTEGER) AS year, CAST(dayofyear(d) AS INTEGER) AS day_of_year FROM {DATED}",
)
def _(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.year("d").alias("year"), F.dayofyear("d").alias("day_of_year"))


@query("weekend_rule", f"SELECT o_orderkey, CAST({T.WEEKEND.format(d='d')} AS INTEGER) AS weekend FROM {DATED}")
def _(spark, sf):
    return _orders(spark, sf).select("o_orderkey", D.weekend_rule(F.col("d")).cast("int").alias("weekend"))


@query("minutes_of_day", f"SELECT event_id, round({T.MINUTES.format(t='ts')}, 9) AS minutes FROM events")
def _(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return T.table(spark, sf, "events").select("event_id", F.round(D.minutes_of_day(text), 9).alias("minutes"))


@query(
    "daylight_minutes",
    f"""WITH s AS (SELECT user_id, CAST(ts AS DATE) AS d, min(ts) AS first, max(ts) AS last FROM events GROUP BY ALL)
        SELECT user_id, d, round({T.MINUTES.format(t='last')} - {T.MINUTES.format(t='first')}, 9) AS minutes FROM s""",
)
def _(spark, sf):
    days = T.table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("d")).agg(
        F.min("ts").alias("first"), F.max("ts").alias("last")
    )
    return days.select("user_id", "d", F.round(D.daylight_minutes(F.col("first"), F.col("last")), 9).alias("minutes"))


def _cycle_sql(d: str, digits: int) -> str:
    waves = [(f"isodow({d}) - 1", 7, "day_of_week"), (f"dayofyear({d})", 365, "day_of_year")]
    return ", ".join(
        f"round({wave}(2 * pi() * ({x}) / {period}), {digits}) + 0.0 AS {name}_{wave}"
        for x, period, name in waves
        for wave in ("sin", "cos")
    )


@query("cyclic_encode", f"SELECT o_orderkey, {_cycle_sql('d', 6)} FROM {DATED}")
def _(spark, sf):
    day = F.col("d")
    return rounded(_orders(spark, sf).select("o_orderkey", *E.cyclic_columns(day, D.day_index_strict(D.day_name(day)))), 6)


@query("encode_temporal", f"SELECT o_orderkey, {_cycle_sql('d', 6)} FROM {DATED}")
def _(spark, sf):
    named = _orders(spark, sf).withColumn("day_of_week", D.day_name(F.col("d")))
    return rounded(E.encode_temporal(named, "d"), 6)


@query(
    "trim_lower_map",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS done FROM orders",
)
def _(spark, sf):
    padded = F.concat(F.lit(" \t"), F.col("o_orderstatus"), F.lit(" "))
    return T.table(spark, sf, "orders").select("o_orderkey", X.trim_lower_map(padded, {"f": True, "o": False}).alias("done"))


FLAG_TEXT = """CASE CAST(o_orderkey % 6 AS INT) WHEN 0 THEN ' YES ' WHEN 1 THEN 'no' WHEN 2 THEN 'True' WHEN 3 THEN '0'
  WHEN 4 THEN '2' ELSE '0.5' END"""


@query(
    "boolean_to_int",
    "SELECT o_orderkey, CAST(CASE o_orderkey % 6 WHEN 0 THEN 1 WHEN 2 THEN 1 WHEN 4 THEN 2 ELSE 0 END AS INTEGER) AS flag FROM orders",
)
def _(spark, sf):
    texts = T.table(spark, sf, "orders").select("o_orderkey", F.expr(FLAG_TEXT).alias("t"))
    return texts.select("o_orderkey", X.boolean_to_int(F.col("t")).cast("int").alias("flag"))


@query("encode_booleans", "SELECT doc_id, quality, toxic FROM labels")
def _(spark, sf):
    texts = T.table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, " Yes").otherwise("NO ").alias("quality"), (F.col("toxic") == 1).alias("toxic")
    )
    return E.encode_booleans(texts, ["quality", "toxic"]).select(
        "doc_id", F.col("quality").cast("int"), F.col("toxic").cast("int")
    )


@query("join_text", "SELECT p_partkey, concat_ws(' | ', p_brand, nullif(p_type, p_type), p_name) AS label FROM part")
def _(spark, sf):
    absent = F.nullif(F.col("p_type"), F.col("p_type"))
    return T.table(spark, sf, "part").select("p_partkey", X.join_text(" | ", F.col("p_brand"), absent, F.col("p_name")).alias("label"))


@query("round_n", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / 7, 3) + 0.0 AS v FROM lineitem")
def _(spark, sf):
    return T.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", N.round_n(F.col("l_extendedprice") / 7, 3).alias("v")
    )


@query(
    "mean_of_two",
    "SELECT l_orderkey, l_linenumber, l_partkey, round((l_tax * 100 + l_quantity) / 2, 4) AS v FROM lineitem",
)
def _(spark, sf):
    return T.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(N.mean_of_two(N.scale(F.col("l_tax"), 100.0), F.col("l_quantity")), 4).alias("v"),
    )


@query(
    "type_casts",
    """SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS key, CAST(trunc(o_totalprice) AS BIGINT) AS price,
       CAST(o_custkey AS DOUBLE) AS number, try_cast(o_orderstatus AS INTEGER) IS NULL AS no_number FROM orders""",
)
def _(spark, sf):
    return T.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("key"), F.col("o_totalprice").cast("bigint").alias("price"),
        F.col("o_custkey").cast("double").alias("number"), F.col("o_orderstatus").try_cast("int").isNull().alias("no_number"),
    )


@query("fill_missing", "SELECT doc_id, coalesce(quality, -1) AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def _(spark, sf):
    labelled = T.table(spark, sf, "documents").select("doc_id").join(T.table(spark, sf, "labels"), "doc_id", "left")
    return labelled.select("doc_id", N.fill_missing(F.col("quality"), F.lit(-1)).alias("quality"))


@query("sectioned_dates", f"WITH {T.HOLIDAYS} SELECT holiday_date FROM holidays")
def _(spark, sf):
    return sectioned_dates(T.calendar_lines(spark, sf), "doc", "block", "pos", "line")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "one_hot",
    f"WITH {T.FACTS} SELECT k, volume, {dummies_sql('area', AREAS)}, {dummies_sql('weather', PRIORITIES)} FROM facts",
)
def _(spark, sf):
    return E.one_hot(T.facts(spark, sf).select("k", "volume", "area", "weather"), ["area", "weather"])


def enriched(spark, sf):
    listed = sectioned_dates(T.calendar_lines(spark, sf), "doc", "block", "pos", "line")
    return enrich_dataset(T.traffic(spark, sf), daily_weather(T.weather(spark, sf), [S.WEATHER_DATE]), listed)


def _double_sql(names: list[str], digits: int = 9) -> str:
    return ", ".join(f'round("{n}", {digits}) + 0.0 AS "{n}"' for n in names)


ORDER_DOUBLES = [c for c in S.MEASURES if c not in ("Incident Reports", "Pedestrian and Cyclist Count")]
ENRICHED_DOUBLES = [*ORDER_DOUBLES, *S.WEATHER_FEATURES, S.DAYLIGHT]


@query(
    "enrich_dataset",
    f"""WITH {T.ENRICHED} SELECT * EXCLUDE ({", ".join(f'"{c}"' for c in ENRICHED_DOUBLES)}),
        {_double_sql(ENRICHED_DOUBLES)} FROM enriched""",
)
def _(spark, sf):
    return rounded(enriched(spark, sf), 9)


WEATHERS = ["Clear", "Fog", "Overcast", "Rain", "Windy"]
ENCODED_SQL = f"""WITH {T.ENRICHED} SELECT k, {_double_sql(ENRICHED_DOUBLES)}, "Incident Reports",
  "Pedestrian and Cyclist Count", CAST(is_holiday AS TINYINT) AS is_holiday,
  CAST("Roadwork and Construction Activity" AS TINYINT) AS "Roadwork and Construction Activity",
  {_cycle_sql('"Date"', 9)}, {dummies_sql(S.WEATHER, WEATHERS)}, {dummies_sql(S.AREA, AREAS)},
  {dummies_sql(S.ROAD, NATIONS)} FROM enriched"""


def encoded(spark, sf, passthrough=()):
    """The categories come from the traffic rows, before weather and calendar are joined, so nothing is written for them."""
    levels = level_values(T.traffic(spark, sf).select(S.WEATHER, S.AREA, S.ROAD), S.CATEGORICALS)
    return E.encode_dataset(enriched(spark, sf), levels=levels, drop=("sunrise", "sunset"), passthrough=passthrough)


@query("encode_dataset", ENCODED_SQL)
def _(spark, sf):
    return rounded(encoded(spark, sf), 9)


@query(
    "encode_then_subset",
    f"""SELECT "{'", "'.join([*S.DIRECT_FEATURES, *S.CYCLE_FEATURES, S.IS_HOLIDAY])}",
        {", ".join(f'"{S.WEATHER}_{w}"' for w in WEATHERS)}, {", ".join(f'"{S.AREA}_{a}"' for a in AREAS)},
        {", ".join(f'"{S.ROAD}_{n}"' for n in NATIONS)} FROM ({ENCODED_SQL})""",
)
def _(spark, sf):
    kept, _missing = P.select_allowlist_stable(encoded(spark, sf))
    return rounded(kept, 9)


PROFILE_MEANS = [c for c in S.MEASURES if c != "Incident Reports"]
PROFILE_CTES = f"""{T.TRAFFIC},
  t AS (SELECT "Area Name" AS area, "Road/Intersection Name" AS road, "Weather Conditions" AS weather,
          "Roadwork and Construction Activity" AS roadwork FROM traffic),
  g AS (SELECT "Area Name" AS area, "Road/Intersection Name" AS road,
          {", ".join(f'avg("{c}") AS "{c}"' for c in PROFILE_MEANS)},
          CAST(sum("Incident Reports") AS BIGINT) AS "Incident Reports" FROM traffic GROUP BY 1, 2),
  profile AS (SELECT g.area AS "Area Name", g.road AS "Road/Intersection Name", g.* EXCLUDE (area, road),
          w.weather AS "Weather Conditions", r.roadwork AS "Roadwork and Construction Activity" FROM g
          JOIN {mode_sql("t", "area, road", "weather", "weather")} w USING (area, road)
          JOIN {mode_sql("t", "area, road", "roadwork", "roadwork")} r USING (area, road))"""
# Written out, not derived from the rule table that they check.
ADVISED_SQL = """concat_ws(' | ',
  CASE WHEN "Congestion Level" > 75 THEN 'Congestion high: avoid at peak hours'
       WHEN "Congestion Level" > 50 AND "Congestion Level" < 75 THEN 'Congestion moderate: allow extra time'
       ELSE 'Congestion low: free flow' END,
  CASE WHEN "Incident Reports" > 10 THEN 'Incidents frequent: delays are likely'
       WHEN "Incident Reports" > 5 THEN 'Incidents occasional: short delays possible' ELSE 'Incidents rare' END,
  CASE WHEN "Environmental Impact" > 150 THEN 'Emissions high: travel less if possible'
       WHEN "Environmental Impact" > 100 THEN 'Emissions moderate: watch air quality' ELSE 'Emissions low' END,
  CASE WHEN "Average Speed" < 20 THEN 'Speed low: slow traffic' WHEN "Average Speed" < 40 THEN 'Speed moderate'
       ELSE 'Speed high' END,
  CASE WHEN "Travel Time Index" > 1.3 THEN 'Trips take longer than usual' ELSE 'Trips take the usual time' END,
  CASE "Weather Conditions" WHEN 'Rain' THEN 'Wet roads: drive with care' WHEN 'Fog' THEN 'Poor sight: keep a distance'
       WHEN 'Clear' THEN 'Weather clear' END)"""


@query(
    "area_road_profile",
    f"""WITH {PROFILE_CTES} SELECT "Area Name", "Road/Intersection Name", {", ".join(f'round(round("{c}", 7), 4) + 0.0 AS "{c}"' for c in PROFILE_MEANS)},
        "Incident Reports", "Weather Conditions", "Roadwork and Construction Activity" FROM profile""",
)
def _(spark, sf):
    return rounded(rounded(area_road_profile(T.traffic(spark, sf)), 7), 4)


@query(
    "advisory_rules",
    f"""WITH {PROFILE_CTES} SELECT "Area Name", "Road/Intersection Name", "Incident Reports", "Weather Conditions",
        {ADVISED_SQL} AS "Overall Advisory" FROM profile""",
)
def _(spark, sf):
    return area_road_advisories(T.traffic(spark, sf)).select(
        S.AREA, S.ROAD, "Incident Reports", S.WEATHER, "Overall Advisory"
    )


@query(
    "advisory_rules_per_row",
    f"""WITH {T.TRAFFIC} SELECT k, {ADVISED_SQL} AS "Overall Advisory" FROM traffic""",
)
def _(spark, sf):
    return advisory_rules(T.traffic(spark, sf)).select("k", "Overall Advisory")


@query(
    "report_lines",
    f"""WITH {PROFILE_CTES} SELECT 'Area: ' || "Area Name" || ', Street: ' || "Road/Intersection Name" ||
        ', Advisory: ' || {ADVISED_SQL} AS line FROM profile""",
)
def _(spark, sf):
    advised = area_road_advisories(T.traffic(spark, sf))
    return report_lines(advised, [("Area", S.AREA), ("Street", S.ROAD), ("Advisory", "Overall Advisory")])


SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "standardize",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
        {", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0 AS {c}" for c in SCALED)}
        FROM lineitem""",
)
def _(spark, sf):
    lines = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *SCALED)
    return rounded(standardize(lines, SCALED), 6)


@query(
    "weekday_pivot",
    "SELECT event_type, "
    + ", ".join(f"round(coalesce(sum(value) FILTER (WHERE isodow(ts) = {i + 1}), 0), 2) AS \"{n}\"" for i, n in enumerate(D.DAY_INDEX))
    + " FROM events GROUP BY event_type",
)
def _(spark, sf):
    from urbanflow.operators.aggregates import pivot_sum

    events = T.table(spark, sf, "events").select("event_type", D.day_name(F.col("ts")).alias("day"), "value")
    return rounded(pivot_sum(events, "event_type", "day", "value", list(D.DAY_INDEX), fill=0.0), 2)
