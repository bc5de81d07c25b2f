"""Joins, membership flags, de-duplication and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanflow.functions.names import col_q
from urbanflow.operators.projection import filter_before_cutoff
from urbanflow.session import join_lookup


def enrich_left_join(facts: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Left-join facts to a dimension that is unique on `on`: the row count is preserved.

    Missing keys match nothing. A key that the dimension repeats is an error, and so are columns of the dimension that
    the facts also have, because a silent suffix would hide one of them.
    """
    clash = [c for c in dimension.columns if c != on and c in facts.columns]
    if clash:
        raise ValueError(f"both sides have columns {clash}: rename them first")
    return join_lookup(facts, dimension, [on], "left", unique=True)


def holiday_flag(df: DataFrame, column: str, dates: DataFrame, out: str = "listed") -> DataFrame:
    """Add a flag that tells whether the date occurs in the one-column table `dates`; no row is lost or repeated."""
    listed = dates.select(F.col(dates.columns[0]).alias(column)).distinct().withColumn("__listed", F.lit(True))
    joined = join_lookup(df, listed.where(col_q(column).isNotNull()), [column], "left")
    return joined.withColumn(out, F.coalesce("__listed", F.lit(False))).drop("__listed")


def attach_by_key(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Attach columns of another table row by row, by key. Both sides are as large as the data: a shuffled join."""
    return left.join(right.select(col_q(key), *map(col_q, columns)), key, "left")


def dedup_keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by an explicit order, whatever the partitioning.

    Spark limits each group before the shuffle as well, so a hot key sends one row per task. Missing keys form one
    group, like any other value.
    """
    first = W.partitionBy(*map(col_q, keys)).orderBy(*map(col_q, order))
    return df.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(col_q(column)).distinct().orderBy(col_q(column))


def stitch_at_cutoff(earlier: DataFrame, later: DataFrame, column: str, cutoff: str) -> DataFrame:
    """Rows of `earlier` before the cutoff, then all of `later`; columns meet by name, absent ones are NULL."""
    return filter_before_cutoff(earlier, column, cutoff).unionByName(later, allowMissingColumns=True)


def train_val_union(df: DataFrame, split: str = "split", parts: tuple[str, ...] = ("train", "val")) -> DataFrame:
    """Rows of the named splits: one filtered scan instead of a union of two."""
    return df.where(col_q(split).isin(*parts))
