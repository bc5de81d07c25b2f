"""Encoding and the two column-subset jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from urbanflow.operators.encode import encode_watched
from urbanflow.operators.projection import select_allowlist_ordered, select_allowlist_stable
from urbanflow.sources.tables import read_table, write_table, write_verified


def run_encoding(spark: SparkSession, enriched: str, out: str, drop: tuple[str, ...] = ("sunrise", "sunset"), schema=None, **options) -> tuple[int, int]:
    """Write the all-numeric table and return (rows, columns).

    Dates, day names and flags are checked as the rows are written; an error lists all bad values, and `out` stays as it was.
    """
    table = read_table(spark, enriched, schema)
    encoded, watch = encode_watched(table, drop=tuple(c for c in drop if c in table.columns), **options)
    return write_verified(encoded, out, watch.verify)


def run_subset_ordered(spark: SparkSession, encoded: str, out: str, schema=None) -> tuple[int, int]:
    return write_table(select_allowlist_ordered(read_table(spark, encoded, schema)), out)


def run_subset_stable(spark: SparkSession, encoded: str, out: str, schema=None) -> tuple[int, int, list[str]]:
    """(rows, columns, direct columns that are missing)."""
    table, missing = select_allowlist_stable(read_table(spark, encoded, schema))
    return (*write_table(table, out), missing)
