"""Row numbers of any size: every partition counts its rows, and what comes before it is added.

No window over the whole table: only one number per partition is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflow.functions.names import col_q
from urbanflow.session import drop_table, join_lookup, materialize
from urbanflow.sources.tables import read_table

# Where monotonically_increasing_id keeps the number inside a partition.
_INSIDE_BITS = 33


def row_numbers(df: DataFrame, order: list, out: str = "position", start: int = 0, partitions: int | None = None) -> DataFrame:
    """`df` with the number of each row in `order` (column names or orderings), counted from `start`.

    Rows are dealt by ranges of the order and sorted inside them; rows equal in all of `order` are numbered in any order
    and lie in one range.
    """
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    keys = [col_q(c) if isinstance(c, str) else c for c in order]
    dealt = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    sorted_rows = dealt.sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id())
    rows = materialize(sorted_rows)
    part = F.shiftright(F.col("__id"), _INSIDE_BITS)
    counts = rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    offsets = _running(counts, ["__part"], [])
    inside = F.col("__id").bitwiseAND(F.lit((1 << _INSIDE_BITS) - 1))
    numbered = join_lookup(rows.withColumn("__part", part), offsets, ["__part"], "inner")
    return numbered.withColumn(out, (F.col("before") + inside + F.lit(start)).cast("long")).drop("__id", "__part", "before")


def _running(counts: DataFrame, order: list[str], groups: list[str]) -> DataFrame:
    """The rows before each entry of (order, n); one row per partition or split, so one task suffices."""
    over = W.partitionBy(*groups).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return counts.select(*groups, *[c for c in order if c not in groups], F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))


def file_positions(spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str | None = None, out: str = "position") -> DataFrame:
    """The rows of a table as they stand in its files, numbered from 0: files by name, rows by their place in the file.

    A file that several tasks read is numbered by the places where its splits begin; a split is read by one task, so its
    rows follow each other.
    """
    rows = read_table(spark, path, schema, fmt)
    if out in rows.columns:
        raise ValueError(f"column {out} exists")
    placed = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"))
    placed = materialize(placed)
    counts = placed.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("__first"))
    before = _running(counts, ["__file", "__block"], []).join(counts.drop("n"), ["__file", "__block"])
    joined = join_lookup(placed, before, ["__file", "__block"], "inner")
    return joined.withColumn(out, (F.col("before") + F.col("__id") - F.col("__first")).cast("long")).drop("__file", "__block", "__id", "__first", "before")


def positional_attach(left: DataFrame, right: DataFrame, position: str = "position") -> DataFrame:
    """The columns of both tables on rows of equal position, which both have; unequal row counts are an error.

    Columns of the same name are an error, too. Positions are unique, so no task gets more than its share.
    """
    both = [c for c in right.columns if c in left.columns and c != position]
    if both:
        raise ValueError(f"columns in both tables: {both}")
    left, right = materialize(left), materialize(right)
    counts = [t.count() for t in (left, right)]
    if counts[0] != counts[1]:
        drop_table(left)
        drop_table(right)
        raise ValueError(f"{counts[0]} and {counts[1]} rows cannot be attached by position")
    return left.join(right, position)
