"""The holiday calendar: text files with year headings and `month - day, day` lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanflow.functions.names import col_q
from urbanflow.functions.text import strip
from urbanflow.session import materialize
from urbanflow.sources.tables import require_path

# The first three letters of a month name.
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}
# Lines of one text that a single task orders at a time.
BLOCK_LINES = 1 << 16


def carry_forward(df: DataFrame, doc: list[str], block: str, pos: str, value: str, out: str) -> DataFrame:
    """Fill `value` forward along (`block`, `pos`) inside each `doc`.

    The fill is exact but never orders a whole document in one task: rows are ordered inside a block only, and
    the last value of each earlier block (one row per block) is carried into the later ones.
    """
    inside = W.partitionBy(*map(col_q, doc), col_q(block)).orderBy(col_q(pos))
    filled = df.withColumn("__here", F.last(col_q(value), ignorenulls=True).over(inside.rowsBetween(W.unboundedPreceding, 0)))
    blocks = df.groupBy(*map(col_q, doc), col_q(block)).agg(
        F.max_by(col_q(value), F.when(col_q(value).isNotNull(), col_q(pos))).alias("__tail")
    )
    earlier = W.partitionBy(*map(col_q, doc)).orderBy(col_q(block)).rowsBetween(W.unboundedPreceding, -1)
    carried = blocks.select(
        *map(col_q, doc), col_q(block), F.last("__tail", ignorenulls=True).over(earlier).alias("__carry")
    )
    joined = filled.join(carried, [*doc, block])
    return joined.withColumn(out, F.coalesce("__here", "__carry")).drop("__here", "__carry")


def _month_number(text: Column) -> Column:
    key = F.substring(F.lower(strip(text)), 1, 3)
    return F.element_at(F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair]), key)


def sectioned_dates(lines: DataFrame, doc: str, block: str, pos: str, line: str, lenient: bool = False) -> DataFrame:
    """Distinct dates named by calendar lines, as one column `holiday_date`.

    A heading `# 2022` sets the year for the lines below it in the same text; other headings change nothing.
    Every other line needs a `-`: the month before the first one, a comma list of days after it. Lines before the
    first year, unknown months and tokens that are no integer are skipped. A day that the month lacks is an error,
    or is skipped when `lenient`.
    """
    text = strip(col_q(line))
    heading = strip(F.regexp_replace(text, "^#+", ""))
    parsed = lines.select(
        col_q(doc).alias("doc"),
        col_q(block).alias("block"),
        col_q(pos).alias("pos"),
        F.when(text.startswith("#"), F.when(heading.rlike("^[0-9]+$"), heading.try_cast("int"))).alias("heading_year"),
        F.when(~text.startswith("#") & text.contains("-"), text).alias("entry"),
    )
    # Only year headings and entries matter. They are written once, because the fill reads them twice.
    parsed = materialize(parsed.where("heading_year IS NOT NULL OR entry IS NOT NULL"))
    dated = carry_forward(parsed, ["doc"], "block", "pos", "heading_year", "year")
    entry = F.col("entry")
    days = F.replace(F.substring(entry, F.locate("-", entry) + 1, F.length(entry)), F.lit(" "), F.lit(""))
    token = strip(F.col("token"))
    day = F.when(token.rlike("^[+-]?[0-9]+(_[0-9]+)*$"), F.replace(token, F.lit("_"), F.lit("")).cast("int"))
    entries = (
        dated.where("entry IS NOT NULL AND year IS NOT NULL")
        .select("year", _month_number(F.substring_index(entry, "-", 1)).alias("month"), F.split(days, ",").alias("days"))
        .where("month IS NOT NULL")
        .select("year", "month", F.explode("days").alias("token"))
        .select("year", "month", day.alias("day"))
        .where("day IS NOT NULL")
        .distinct()
    )
    written = F.format_string("%04d-%02d-%02d", "year", "month", "day")
    parsed_date = written.try_cast("date")
    failure = F.raise_error(F.concat(F.lit("impossible date: "), written)).cast("date")
    result = entries.select((parsed_date if lenient else F.coalesce(parsed_date, failure)).alias("holiday_date"))
    return result.where("holiday_date IS NOT NULL")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as (doc, block, pos, line).

    Large files are split among tasks; `block` is the byte offset at which a split starts and `pos` grows with the
    reading order inside it, so (block, pos) is the line order of the file.
    """
    require_path(spark, path)
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("doc"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def explode_lines(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Lines of a text column as (doc, block, pos, line)."""
    return df.select(col_q(doc).alias("doc"), F.posexplode(F.split(col_q(text), "\r\n|\r|\n")).alias("pos", "line")).select(
        "doc", F.floor(F.col("pos") / BLOCK_LINES).alias("block"), "pos", "line"
    )


def holiday_calendar(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """Distinct holiday dates of all calendar files under `path`."""
    return sectioned_dates(read_lines(spark, path), "doc", "block", "pos", "line", lenient)
