"""Queries that write files or tables derived from the driver tables below the checkpoint folder and read them back."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from urbanflow.functions.text import WHITE_SPACE
from urbanflow.operators import search as R
from urbanflow.operators.aggregates import level_values
from urbanflow.operators.positions import file_positions, positional_attach, row_numbers
from urbanflow.session import scratch_path
from urbanflow.sources.buckets import write_bucketed
from urbanflow.sources.calendar import MONTHS, explode_lines, holiday_calendar
from urbanflow.sources.quarantine import read_quarantined
from urbanflow.sources.tables import read_table, write_lines, write_table
from urbanflow.workload import tables as T
from urbanflow.workload.registry import query

ORDER_LINES = "o_orderkey BIGINT, o_orderdate DATE, o_totalprice DOUBLE, o_orderpriority STRING"


def _orders(spark, sf):
    return T.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice", "o_orderpriority")


DATED = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderpriority FROM orders"


@query("read_csv", DATED)
def _(spark, sf):
    path = f"{scratch_path(spark)}.csv"
    write_table(_orders(spark, sf), path)
    return read_table(spark, path, ORDER_LINES)


# Records that do not fit: a price that is no number, a day that no month has, a value missing, a value too many.
@query(
    "read_quarantined",
    """SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'o_totalprice: n/a is no double' WHEN o_orderkey % 89 = 0 THEN 'o_orderdate: 1997-02-30 is no date'
         WHEN o_orderkey % 83 = 0 THEN 'fewer than 4 values' WHEN o_orderkey % 79 = 0 THEN 'more than 4 values' ELSE 'read' END AS outcome,
       count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1""",
)
def _(spark, sf):
    price = F.when(F.col("o_orderkey") % 97 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    day = F.when((F.col("o_orderkey") % 89 == 0) & (F.col("o_orderkey") % 97 != 0), "1997-02-30").otherwise(F.col("o_orderdate").cast("string"))
    left = (F.col("o_orderkey") % 97 != 0) & (F.col("o_orderkey") % 89 != 0)
    cells = F.array(F.col("o_orderkey").cast("string"), day, price, F.concat(F.lit('"'), "o_orderpriority", F.lit('"')))
    few = left & (F.col("o_orderkey") % 83 == 0)
    more = left & ~few & (F.col("o_orderkey") % 79 == 0)
    cells = F.when(few, F.slice(cells, 1, 3)).when(more, F.concat(cells, F.array(F.lit("more")))).otherwise(cells)
    path, rejects = scratch_path(spark), scratch_path(spark)
    # As text, since a writer of tables would not write these; every file begins with the header that a reader skips.
    lines = _orders(spark, sf).select(F.concat_ws(",", cells).alias("line"), (F.col("o_orderkey") % 4).alias("file"), F.lit(1).alias("after"))
    header = ",".join(["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"])
    heads = lines.groupBy("file").agg(F.first(F.lit(header)).alias("line")).select("line", "file", F.lit(0).alias("after"))
    lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "after").select("line", "file").write.partitionBy("file").text(path)
    rows, _ = read_quarantined(spark, f"{path}/*", ORDER_LINES, rejects)
    good = rows.select(F.lit("read").alias("outcome"), "o_orderkey")
    bad = spark.read.parquet(rejects).select(F.col("reason").alias("outcome"), F.substring_index("record", ",", 1).cast("long").alias("o_orderkey"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))


@query("write_table", f"SELECT k, d, area, volume, weather FROM (WITH {T.FACTS} SELECT * FROM facts)")
def _(spark, sf):
    path = scratch_path(spark)
    facts = T.facts(spark, sf).select("k", "d", "area", "volume", "weather")
    rows, columns = write_table(facts, path)
    back = read_table(spark, path, facts.schema)
    if (rows, columns) != (back.count(), len(back.columns)):
        raise ValueError(f"{rows} rows and {columns} columns were counted in writing")
    return back


@query("positional_attach", "SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def _(spark, sf):
    """Prices and dates stand in different files, split at different places; only their order says what belongs together."""
    ordered = _orders(spark, sf)
    prices, dates = f"{scratch_path(spark)}.csv", f"{scratch_path(spark)}.csv"
    write_table(ordered.repartitionByRange(7, "o_orderkey").sortWithinPartitions("o_orderkey").select("o_orderkey", "o_totalprice"), prices)
    write_table(ordered.repartitionByRange(3, "o_orderkey").sortWithinPartitions("o_orderkey").select("o_orderdate"), dates)
    left = file_positions(spark, prices, "o_orderkey BIGINT, o_totalprice DOUBLE")
    return positional_attach(left, file_positions(spark, dates, "o_orderdate DATE")).drop("position")


@query(
    "row_numbers",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
       row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) AS position FROM lineitem""",
)
def _(spark, sf):
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
    lines = T.table(spark, sf, "lineitem").select("l_extendedprice", *ties)
    return row_numbers(lines, [F.desc("l_extendedprice"), *ties], start=1).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "position")


@query(
    "write_bucketed",
    f"""WITH {T.FACTS}, days AS (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS lines, max(l_quantity) AS most FROM lineitem GROUP BY 1)
        SELECT area, count(*) AS rows, CAST(sum(lines) AS BIGINT) AS lines, max(most) AS most FROM facts JOIN days USING (d) GROUP BY area""",
)
def _(spark, sf):
    """Facts and days are both dealt by date, so their join reads bucket by bucket."""
    lines = T.table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(F.count(F.lit(1)).alias("lines"), F.max("l_quantity").alias("most"))
    facts = write_bucketed(T.facts(spark, sf).select("d", "area"), "urbanflow_facts_by_day", ["d"], 8, path=scratch_path(spark))
    days = write_bucketed(lines, "urbanflow_days", ["d"], 8, path=scratch_path(spark))
    joined = facts.join(days.hint("merge"), "d")
    return joined.groupBy("area").agg(F.count(F.lit(1)).alias("rows"), F.sum("lines").alias("lines"), F.max("most").alias("most"))


GRID = ["area", "weather", "roadwork"]


@query(
    "param_sampler",
    f"""WITH {T.FACTS} SELECT DISTINCT a.area, b.weather, c.roadwork FROM facts a, (SELECT DISTINCT weather FROM facts) b,
        (SELECT DISTINCT roadwork FROM facts) c""",
)
def _(spark, sf):
    """As many draws as the grid of the facts' levels has points: each point is drawn once."""
    grid = level_values(T.facts(spark, sf).select(*GRID), GRID)
    return R.param_sampler(spark, grid, len(list(product(*grid.values())))).drop("trial_id")


_EDGE = WHITE_SPACE.replace("'", "''")
# A document's year comes from its number; every line of its text stands below that heading, as it is.
@query(
    "holiday_calendar",
    f"""WITH {T.HOLIDAYS}, l AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line, generate_subscripts(regexp_split_to_array(text, '\\r\\n|\\r|\\n'), 1) AS pos
        FROM documents),
      s AS (SELECT doc_id, pos, trim(line, '{_EDGE}') AS line FROM l),
      h AS (SELECT *, CASE WHEN line[1] = '#' THEN try_cast(nullif(regexp_extract(trim(ltrim(line, '#'), '{_EDGE}'), '^[0-9]+$'), '') AS INTEGER) END AS head FROM s),
      y AS (SELECT *, coalesce(last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos), 1990 + doc_id % 30) AS year FROM h),
      e AS (SELECT year, {{m}} AS month, string_split(replace(line[strpos(line, '-') + 1:], ' ', ''), ',') AS days FROM y WHERE line[1] <> '#' AND contains(line, '-')),
      d AS (SELECT year, month, trim(unnest(days), '{_EDGE}') AS token FROM e WHERE month IS NOT NULL)
      SELECT holiday_date FROM holidays UNION
      SELECT try_cast(printf('%04d-%02d-%02d', year, month, CAST(replace(token, '_', '') AS INTEGER)) AS DATE) AS holiday_date FROM d
      WHERE regexp_full_match(token, '[+-]?[0-9]{{1,2}}(_[0-9])*') AND holiday_date IS NOT NULL""".replace(
        "{m}", f"map {MONTHS}[lower(trim(split_part(line, '-', 1), '{_EDGE}')[1:3])]"
    ),
)
def _(spark, sf):
    """Text files of the listed days, and of all lines of all documents under a heading each."""
    docs = T.table(spark, sf, "documents")
    lines = explode_lines(docs, "doc_id", "text").select(F.col("doc").cast("string").alias("doc"), F.lit(1).alias("part"), F.col("pos").cast("long").alias("pos"), "line")
    heads = docs.select(F.col("doc_id").cast("string").alias("doc"), F.lit(0).alias("part"), F.lit(0).cast("long").alias("pos"), F.concat(F.lit("# "), (F.lit(1990) + F.col("doc_id") % 30).cast("string")).alias("line"))
    listed = T.calendar_lines(spark, sf).select("doc", F.col("block").cast("int").alias("part"), F.col("pos").cast("long").alias("pos"), "line")
    path = scratch_path(spark)
    write_lines(lines.unionByName(heads).unionByName(listed).repartition(8, "doc").sortWithinPartitions("doc", "part", "pos"), path)
    return holiday_calendar(spark, path, lenient=True)
