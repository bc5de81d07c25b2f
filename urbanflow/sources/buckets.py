"""Bucketed tables: joins and groups on their keys need no shuffle, and a new version replaces the old one whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from urbanflow.functions.names import quoted


def write_bucketed(
    df: DataFrame, name: str, by: list[str], buckets: int, sort: list[str] | None = None, path: str | None = None
) -> DataFrame:
    """Write `df` as the table `name`, dealt into `buckets` by the hash of `by` and sorted inside them; returns the table.

    The rows go to a table of their own first. Only when it is complete does the view `name` point to it, so readers see
    the old rows or the new ones; then the older version is dropped. A write that fails leaves the old rows as they are.
    The files lie in the warehouse, or in `path`, a folder of this version's own.
    """
    spark = df.sparkSession
    version = f"{name}__{uuid.uuid4().hex[:12]}"
    older = versions(spark, name)
    try:
        writer = df.repartition(buckets, *[df[quoted(c)] for c in by]).write.bucketBy(buckets, *by).sortBy(*(sort or by))
        (writer.option("path", path) if path else writer).saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(version)}")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS SELECT * FROM {quoted(version)}")
    for table in older:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
    return spark.table(name)


def versions(spark: SparkSession, name: str) -> list[str]:
    """The tables that hold, or held, the rows of `name`."""
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__") and t.tableType in ("MANAGED", "EXTERNAL")]


def drop_bucketed(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {quoted(name)}")
    for table in versions(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
