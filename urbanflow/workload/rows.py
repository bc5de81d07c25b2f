"""Queries of the row operators: scans, projections, filters, joins, de-duplication, unions, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanflow.functions.names import col_q
from urbanflow.functions.numbers import round_n
from urbanflow.operators import checks as K
from urbanflow.operators import combine as C
from urbanflow.operators import projection as P
from urbanflow.operators.aggregates import row_count, shape
from urbanflow.operators.encode import one_hot
from urbanflow.sources import tables as IO
from urbanflow.workload import tables as T
from urbanflow.workload.registry import query

ORDER_LEVELS = {
    "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "o_orderstatus": ["F", "O", "P"],
}


def dummies_sql(column: str, levels: list[str], source: str | None = None) -> str:
    """0/1 columns of a column in ANSI SQL."""
    source = source or f'"{column}"'
    return ", ".join(f"CAST({source} = '{v}' AS TINYINT) AS \"{column}_{v}\"" for v in levels)


def encoded_orders(spark, sf):
    wide = one_hot(T.table(spark, sf, "orders"), list(ORDER_LEVELS), ORDER_LEVELS)
    return wide.withColumn("o_orderdate", F.to_date("o_orderdate"))


PRIORITY_SQL = dummies_sql("o_orderpriority", ORDER_LEVELS["o_orderpriority"])
STATUS_SQL = dummies_sql("o_orderstatus", ORDER_LEVELS["o_orderstatus"])


@query("read_table", "SELECT * FROM customer")
def _(spark, sf):
    return IO.read_table(spark, f"{sf}/customer.parquet")


@query("scan_pruned", "SELECT l_orderkey, l_discount FROM lineitem")
def _(spark, sf):
    return IO.scan_pruned(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_discount"])


@query(
    "schema_probe",
    """SELECT CAST(ordinal_position - 1 AS INTEGER) AS ordinal, column_name AS name,
    CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
      WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type
    FROM (SELECT row_number() OVER () AS ordinal_position, column_name, column_type AS data_type
          FROM (DESCRIBE SELECT * FROM lineitem))""",
)
def _(spark, sf):
    return IO.schema_probe(IO.read_table(spark, f"{sf}/lineitem.parquet"))


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def _(spark, sf):
    return row_count(T.table(spark, sf, "lineitem"))


@query("shape", "SELECT count(*) AS rows, (SELECT count(*) FROM (DESCRIBE SELECT * FROM lineitem)) AS columns FROM lineitem")
def _(spark, sf):
    return shape(IO.read_table(spark, f"{sf}/lineitem.parquet"))


@query("preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def _(spark, sf):
    return IO.preview(T.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query("head_n", "SELECT event_id, event_type, value FROM events ORDER BY value DESC, event_id LIMIT 5")
def _(spark, sf):
    events = T.table(spark, sf, "events").select("event_id", "event_type", "value")
    return events.orderBy(F.col("value").desc(), "event_id").limit(5)


@query("require_columns", "SELECT l_tax, l_orderkey, l_linenumber FROM lineitem")
def _(spark, sf):
    return K.require_columns(T.table(spark, sf, "lineitem"), ["l_tax", "l_orderkey", "l_linenumber"])


@query("require_path", "SELECT n_nationkey, n_name FROM nation")
def _(spark, sf):
    path = IO.require_path(spark, f"{sf}/nation.parquet")
    return spark.read.parquet(path).select("n_nationkey", "n_name")


@query(
    "select_allowlist_ordered",
    f"SELECT o_totalprice, o_custkey, {STATUS_SQL}, {PRIORITY_SQL} FROM orders",
)
def _(spark, sf):
    return P.select_allowlist_ordered(
        encoded_orders(spark, sf), direct=["o_totalprice", "not there"], derived=["o_custkey"],
        prefixes=["o_orderstatus_", "o_orderpriority_"],
    )


@query("select_allowlist_stable", f"SELECT o_custkey, o_totalprice, {STATUS_SQL} FROM orders")
def _(spark, sf):
    kept, missing = P.select_allowlist_stable(
        encoded_orders(spark, sf), direct=["o_totalprice", "not there"], derived=["o_custkey"], prefixes=["o_orderstatus_"]
    )
    assert missing == ["not there"]
    return kept


@query(
    "select_excluding_substring",
    "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
)
def _(spark, sf):
    return P.select_excluding_substring(encoded_orders(spark, sf), ["priority_", "status_"])


@query("name_predicates", f"SELECT {PRIORITY_SQL} FROM orders WHERE regexp_matches(CAST(o_orderkey AS VARCHAR), '^[0-9]+$')")
def _(spark, sf):
    from urbanflow.functions.names import names_starting_with

    wide = encoded_orders(spark, sf).where(F.col("o_orderkey").cast("string").rlike("^[0-9]+$"))
    return P.keep(wide, names_starting_with(wide.columns, ["o_orderpriority_"]))


@query("rename_column", 'SELECT s_suppkey, s_name AS "Supplier Name", s_nationkey, s_acctbal FROM supplier')
def _(spark, sf):
    return P.rename_column(T.table(spark, sf, "supplier"), "s_name", "Supplier Name")


@query("drop_columns", "SELECT p_partkey, p_brand, p_size FROM part")
def _(spark, sf):
    return P.drop_columns(T.table(spark, sf, "part"), ["p_name", "p_type", "p_retailprice"])


@query(
    "feature_target_split",
    "SELECT l_quantity, l_discount, l_tax, l_extendedprice AS label FROM lineitem",
)
def _(spark, sf):
    lines = T.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    features, label = P.feature_target_split(lines, "l_extendedprice", ["l_orderkey"])
    return lines.select(*map(col_q, features.columns), *[col_q(c).alias("label") for c in label.columns])


@query(
    "filter_before_cutoff",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate < DATE '1998-07-01'""",
)
def _(spark, sf):
    before = P.filter_before_cutoff(T.table(spark, sf, "orders"), "o_orderdate", "1998-07-01")
    return before.select("o_orderkey", F.to_date("o_orderdate").alias("d"))


SPLIT_CASE = "CASE year(o_orderdate) WHEN 1998 THEN 'train' WHEN 1999 THEN 'val' WHEN 2000 THEN 'test' END"


@query(
    "split_by_year",
    f"SELECT o_orderkey, {SPLIT_CASE} AS split FROM orders WHERE year(o_orderdate) IN (1998, 1999, 2000)",
)
def _(spark, sf):
    return P.split_by_year(T.table(spark, sf, "orders"), "o_orderdate", T.YEARS).select("o_orderkey", "split")


@query(
    "train_val_union",
    f"""SELECT o_orderkey, {SPLIT_CASE} AS split FROM orders WHERE year(o_orderdate) = 1998 UNION ALL
        SELECT o_orderkey, {SPLIT_CASE} AS split FROM orders WHERE year(o_orderdate) = 1999""",
)
def _(spark, sf):
    return C.train_val_union(P.split_by_year(T.table(spark, sf, "orders"), "o_orderdate", T.YEARS)).select("o_orderkey", "split")


@query(
    "check_numeric",
    "SELECT l_orderkey, l_quantity, l_tax, l_linenumber FROM lineitem",
)
def _(spark, sf):
    return K.check_numeric(T.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_tax", "l_linenumber"))


@query("check_values", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(spark, sf):
    from urbanflow.functions.text import trim_lower_map

    orders = T.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return K.check_values(orders, "o_orderstatus", trim_lower_map(F.col("o_orderstatus"), {"f": 0, "o": 1, "p": 2}))


@query(
    "offending_values",
    "SELECT lang AS value, count(*) AS rows FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY lang",
)
def _(spark, sf):
    from urbanflow.functions.text import trim_lower_map

    return K.offending_values(T.table(spark, sf, "documents"), "lang", trim_lower_map(F.col("lang"), {"en": 0, "fr": 1}))


@query("check_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def _(spark, sf):
    orders = T.table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    return K.check_dates(orders, "d").withColumn("d", F.to_date("d"))


@query(
    "enrich_left_join",
    f"""WITH {T.FACTS}, {T.WEATHER} SELECT k, d, volume, tempmax, round(dew, 4) AS dew, sunset
        FROM facts LEFT JOIN weather ON d = "datetime" """,
)
def _(spark, sf):
    daily = T.weather(spark, sf).select(F.col("datetime").alias("d"), "tempmax", "dew", "sunset")
    joined = C.enrich_left_join(T.facts(spark, sf).select("k", "d", "volume"), daily, "d")
    return joined.withColumn("dew", round_n(F.col("dew"), 4))


@query(
    "holiday_flag",
    f"""WITH {T.HOLIDAYS} SELECT o_orderkey, CAST(holiday_date IS NOT NULL AS INTEGER) AS listed
        FROM orders LEFT JOIN holidays ON CAST(o_orderdate AS DATE) = holiday_date""",
)
def _(spark, sf):
    orders = T.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    dates = T.table(spark, sf, "orders").where(T.LISTED).select(F.to_date("o_orderdate").alias("holiday_date"))
    return C.holiday_flag(orders, "d", dates).select("o_orderkey", F.col("listed").cast("int"))


@query(
    "attach_by_key",
    f"SELECT o_orderkey, {STATUS_SQL}, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
)
def _(spark, sf):
    encoded = P.select_excluding_substring(encoded_orders(spark, sf), ["priority", "date", "custkey", "price"])
    dates = T.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    return C.attach_by_key(encoded, dates, "o_orderkey", ["o_orderdate"])


DEDUP_ORDER = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"]


@query(
    "dedup_keep_first",
    f"""SELECT d, l_orderkey, l_linenumber, l_extendedprice FROM (
          SELECT CAST(l_shipdate AS DATE) AS d, *, row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE)
                 ORDER BY {", ".join(DEDUP_ORDER)}) AS n FROM lineitem) WHERE n = 1""",
)
def _(spark, sf):
    lines = T.table(spark, sf, "lineitem").withColumn("d", F.to_date("l_shipdate"))
    return C.dedup_keep_first(lines, ["d"], DEDUP_ORDER).select("d", "l_orderkey", "l_linenumber", "l_extendedprice")


@query("distinct_values", "SELECT DISTINCT p_type FROM part")
def _(spark, sf):
    return C.distinct_values(T.table(spark, sf, "part"), "p_type")


@query(
    "stitch_at_cutoff",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, NULL::DOUBLE AS extra FROM orders
         WHERE o_orderdate < DATE '1999-01-01' AND o_orderdate < DATE '1998-07-01'
       UNION ALL
       SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice AS extra FROM orders
         WHERE o_orderdate >= DATE '1998-01-01'""",
)
def _(spark, sf):
    orders = T.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"), "o_totalprice")
    earlier = orders.where("d < DATE '1999-01-01'").drop("o_totalprice")
    later = orders.where("d >= DATE '1998-01-01'").withColumnRenamed("o_totalprice", "extra")
    return C.stitch_at_cutoff(earlier, later, "d", "1998-07-01")


@query(
    "sort_by_key",
    "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey ORDER BY o_custkey",
)
def _(spark, sf):
    return T.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders")).orderBy("o_custkey")


@query("sort_desc", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST")
def _(spark, sf):
    return T.table(spark, sf, "customer").select("c_custkey", "c_acctbal").orderBy(F.col("c_acctbal").desc_nulls_last())
