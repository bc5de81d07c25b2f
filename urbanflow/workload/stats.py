"""Queries of the grouped aggregates, summaries, correlations and bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanflow.functions.names import col_q
from urbanflow.functions.numbers import round_n
from urbanflow.operators import aggregates as A
from urbanflow.operators import bins as B
from urbanflow.operators import statistics as X
from urbanflow.operators.quantiles import exact_quantiles
from urbanflow.session import materialize
from urbanflow.workload import tables as T
from urbanflow.workload.registry import query

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def rounded(df, digits: int):
    """All floating columns rounded."""
    kinds = dict(df.dtypes)
    return df.select([round_n(col_q(c), digits).alias(c) if kinds[c] == "double" else col_q(c) for c in df.columns])


@query(
    "year_counts",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows FROM orders GROUP BY 1 ORDER BY 1",
)
def _(spark, sf):
    return A.year_counts(T.table(spark, sf, "orders"), "o_orderdate")


@query("group_sum", f"WITH {T.FACTS} SELECT area, round(sum(volume), 2) AS total FROM facts GROUP BY area")
def _(spark, sf):
    return rounded(A.group_sum(T.facts(spark, sf), ["area"], "volume"), 2)


@query(
    "group_sum_2keys",
    f"""WITH {T.FACTS} SELECT area, road, round(sum(volume), 2) AS total, area || ' - ' || road AS label
        FROM facts GROUP BY area, road""",
)
def _(spark, sf):
    return rounded(A.group_sum_labelled(T.facts(spark, sf), "area", "road", "volume"), 2)


@query("group_mean", f"WITH {T.FACTS} SELECT area, round(avg(volume), 4) AS mean FROM facts GROUP BY area")
def _(spark, sf):
    return rounded(A.group_mean(T.facts(spark, sf), ["area"], "volume"), 4)


@query(
    "group_mode",
    """SELECT l_suppkey, l_partkey AS mode FROM (
         SELECT l_suppkey, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_partkey) AS n
         FROM lineitem GROUP BY l_suppkey, l_partkey) WHERE n = 1""",
)
def _(spark, sf):
    return A.group_mode(T.table(spark, sf, "lineitem"), ["l_suppkey"], "l_partkey")


def mode_sql(source: str, keys: str, column: str, out: str) -> str:
    return f"""(SELECT {keys}, {column} AS {out} FROM (SELECT {keys}, {column}, row_number() OVER (
      PARTITION BY {keys} ORDER BY count(*) DESC, {column}) AS n FROM {source} GROUP BY {keys}, {column}) WHERE n = 1)"""


@query(
    "mixed_agg_profile",
    f"""WITH {T.TRAFFIC},
      t AS (SELECT "Area Name" AS area, "Road/Intersection Name" AS road, "Traffic Volume" AS volume,
              "Average Speed" AS speed, "Incident Reports" AS incidents, "Weather Conditions" AS weather,
              "Roadwork and Construction Activity" AS roadwork FROM traffic),
      g AS (SELECT area, road, round(round(avg(volume), 7), 4) AS volume, round(round(avg(speed), 7), 4) AS speed,
              CAST(sum(incidents) AS BIGINT) AS incidents FROM t GROUP BY area, road)
      SELECT g.*, w.weather, r.roadwork FROM g
        JOIN {mode_sql("t", "area, road", "weather", "weather")} w USING (area, road)
        JOIN {mode_sql("t", "area, road", "roadwork", "roadwork")} r USING (area, road)""",
)
def _(spark, sf):
    t = T.traffic(spark, sf).select(
        F.col("Area Name").alias("area"), col_q("Road/Intersection Name").alias("road"),
        F.col("Traffic Volume").alias("volume"), F.col("Average Speed").alias("speed"),
        F.col("Incident Reports").alias("incidents"), F.col("Weather Conditions").alias("weather"),
        F.col("Roadwork and Construction Activity").alias("roadwork"),
    )
    # Seven digits first: they drop what the order of a sum does, so that a tie at four digits goes the same way.
    return rounded(rounded(A.mixed_profile(t, ["area", "road"], ["volume", "speed"], ["incidents"], ["weather", "roadwork"]), 7), 4)


NATIONS = sorted(f"NATION_{i}" for i in range(25))
AREAS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query(
    "pivot_sum",
    f"""WITH {T.FACTS} SELECT area,
        {", ".join(f"round(sum(volume) FILTER (WHERE road = '{n}'), 2) AS \"{n}\"" for n in NATIONS)}
        FROM facts GROUP BY area""",
)
def _(spark, sf):
    return rounded(A.pivot_sum(T.facts(spark, sf), "area", "road", "volume"), 2)


@query(
    "pivot_sum_filled",
    f"""WITH {T.FACTS} SELECT road,
        {", ".join(f"coalesce(round(sum(volume) FILTER (WHERE area = '{a}'), 2), 0.0) AS \"{a}\"" for a in AREAS)}
        FROM facts GROUP BY road""",
)
def _(spark, sf):
    return rounded(A.pivot_sum(T.facts(spark, sf), "road", "area", "volume", fill=0.0), 2)


@query(
    "share_of_total",
    f"""WITH {T.FACTS} SELECT area, round(sum(volume), 2) AS total,
        round(100 * sum(volume) / sum(sum(volume)) OVER (), 1) AS share FROM facts GROUP BY area""",
)
def _(spark, sf):
    return rounded(A.share_of_total(T.facts(spark, sf), "area", "volume"), 2)


@query(
    "ratio_to_max",
    f"""WITH {T.FACTS} SELECT area, round(avg(volume), 6) AS mean, round(avg(volume) / max(avg(volume)) OVER (), 6) AS ratio
        FROM facts GROUP BY area""",
)
def _(spark, sf):
    return rounded(A.ratio_to_max(T.facts(spark, sf), "area", "volume"), 6)


def _describe_numbers_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
            round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 6) AS q25,
            round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS q50,
            round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 6) AS q75, round(CAST(max({c}) AS DOUBLE), 6) AS max
            FROM {table}"""
        for c in columns
    )


def _describe_texts_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
            min(v) FILTER (WHERE n = top_n) AS top, CAST(max(n) AS BIGINT) AS freq
            FROM (SELECT v, n, max(n) OVER () AS top_n FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {table}
                  WHERE {c} IS NOT NULL GROUP BY 1))"""
        for c in columns
    )


@query("describe_columns", _describe_numbers_sql("lineitem", LINE_NUMBERS))
def _(spark, sf):
    return rounded(X.describe_columns(T.table(spark, sf, "lineitem"), LINE_NUMBERS), 6)


@query("describe_texts", _describe_texts_sql("documents", ["lang", "source", "text"]))
def _(spark, sf):
    return X.describe_columns(T.table(spark, sf, "documents"), ["lang", "source", "text"])


def _corr_sql(table: str, columns: list[str], digits: int) -> str:
    cells = [
        f"""SELECT '{a}' AS x, '{b}' AS y, CASE WHEN min({a}) < max({a}) AND min({b}) < max({b})
              THEN round({'1.0::DOUBLE' if a == b else f'corr({a}, {b})'}, {digits}) + 0.0 END AS r FROM {table}"""
        for a in columns
        for b in columns
    ]
    return " UNION ALL ".join(f"({c})" for c in cells)


@query("corr_matrix", _corr_sql("lineitem", LINE_NUMBERS, 6))
def _(spark, sf):
    return X.corr_matrix(T.table(spark, sf, "lineitem").select(LINE_NUMBERS), digits=6)


DAY_NUMBERS = [c for c, _ in T.DAY_MEASURES if c not in ("sunrise", "sunset")]


@query("corr_matrix_rounded", f"WITH {T.WEATHER} " + _corr_sql("weather", DAY_NUMBERS, 3))
def _(spark, sf):
    return X.corr_matrix(materialize(T.weather(spark, sf).select(DAY_NUMBERS)), DAY_NUMBERS, digits=3)


@query(
    "target_correlation",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 6) + 0.0 AS r FROM lineitem"
        for c in LINE_NUMBERS
        if c != "l_extendedprice"
    ),
)
def _(spark, sf):
    return rounded(X.target_correlation(T.table(spark, sf, "lineitem").select(LINE_NUMBERS), "l_extendedprice"), 6)


@query(
    "histogram",
    """WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
      e AS (SELECT i AS bin, CASE WHEN i = 20 THEN hi ELSE lo + i * ((hi - lo) / 20.0::DOUBLE) END AS edge
            FROM range(21) t(i), s),
      b AS (SELECT e.bin, e.edge AS left_edge, f.edge AS right_edge FROM e JOIN e f ON f.bin = e.bin + 1)
      SELECT bin, round(left_edge, 6) AS left_edge, round(right_edge, 6) AS right_edge,
        (SELECT count(*) FROM orders WHERE o_totalprice >= left_edge
           AND (o_totalprice < right_edge OR (bin = 19 AND o_totalprice = right_edge))) AS rows FROM b""",
)
def _(spark, sf):
    return rounded(B.histogram(T.table(spark, sf, "orders"), "o_totalprice"), 6)


@query(
    "hexbin_density",
    """WITH s AS (SELECT min(value) - 1e-9 * (max(value) - min(value)) AS x0, max(value) + 1e-9 * (max(value) - min(value)) AS x1,
           min(user_id)::DOUBLE AS y0, max(user_id)::DOUBLE AS y1 FROM events),
      p AS (SELECT (value - x0) / ((x1 - x0) / 30) AS u, (user_id - y0) / ((y1 - y0) / 17) AS w,
              x0, (x1 - x0) / 30 AS sx, y0, (y1 - y0) / 17 AS sy FROM events, s),
      c AS (SELECT *, power(u - round_even(u, 0), 2) + 3 * power(w - round_even(w, 0), 2) AS d1,
              power(u - floor(u) - 0.5, 2) + 3 * power(w - floor(w) - 0.5, 2) AS d2 FROM p),
      a AS (SELECT CASE WHEN d1 < d2 THEN 1 ELSE 2 END AS lattice,
              CAST(CASE WHEN d1 < d2 THEN round_even(u, 0) ELSE floor(u) END AS BIGINT) AS ix,
              CAST(CASE WHEN d1 < d2 THEN round_even(w, 0) ELSE floor(w) END AS BIGINT) AS iy, x0, sx, y0, sy FROM c)
      SELECT lattice, ix, iy, round(x0 + (ix + CASE lattice WHEN 2 THEN 0.5 ELSE 0 END) * sx, 4) AS x_center,
        round(y0 + (iy + CASE lattice WHEN 2 THEN 0.5 ELSE 0 END) * sy, 4) AS y_center, count(*) AS rows
      FROM a GROUP BY ALL""",
)
def _(spark, sf):
    return rounded(B.hexbin_density(T.table(spark, sf, "events"), "value", "user_id"), 4)


def box_sql(source: str, keys: str, value: str) -> str:
    return f"""WITH src AS (SELECT * FROM ({source})), q AS (
        SELECT {keys}, count({value}) AS n, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
          quantile_cont({value}, 0.75) AS q3 FROM src GROUP BY {keys})
      SELECT {keys}, n, round(least(q1, min({value}) FILTER (WHERE {value} >= q1 - 1.5 * (q3 - q1))), 6) AS whisker_lo,
        round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
        round(greatest(q3, max({value}) FILTER (WHERE {value} <= q3 + 1.5 * (q3 - q1))), 6) AS whisker_hi,
        count(*) FILTER (WHERE {value} < q1 - 1.5 * (q3 - q1) OR {value} > q3 + 1.5 * (q3 - q1)) AS outliers
      FROM src JOIN q USING ({keys}) GROUP BY {keys}, n, q1, median, q3"""


@query("box_stats", box_sql("SELECT event_type, value FROM events", "event_type", "value"))
def _(spark, sf):
    return rounded(B.box_stats(T.table(spark, sf, "events"), ["event_type"], "value"), 6)


@query(
    "box_outliers",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
                  FROM events GROUP BY event_type)
       SELECT event_id, event_type, value FROM events JOIN q USING (event_type)
       WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
)
def _(spark, sf):
    events = T.table(spark, sf, "events").select("event_id", "event_type", "value")
    return B.box_outliers(events, ["event_type"], "value")


# The way of large groups, forced by a small limit on the rows that one task may order.
@query(
    "quantiles_of_large_groups",
    """SELECT l_returnflag, count(*) AS n, round(quantile_cont(l_extendedprice, 0.01), 6) AS low,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.99), 6) AS high
       FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, sf):
    probs = {"low": 0.01, "median": 0.5, "high": 0.99}
    return rounded(exact_quantiles(T.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", probs, 1000, 100), 6)


BOX_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "box_stats_unpivot",
    box_sql(
        " UNION ALL ".join(f"SELECT l_returnflag, '{c}' AS \"column\", {c} AS value FROM lineitem" for c in BOX_COLUMNS),
        'l_returnflag, "column"',
        "value",
    ),
)
def _(spark, sf):
    return rounded(B.box_stats_unpivot(T.table(spark, sf, "lineitem"), "l_returnflag", BOX_COLUMNS), 6)
