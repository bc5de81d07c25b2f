"""Table readers and writers: CSV with a header, or Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflow.functions.names import col_q, quoted
from urbanflow.session import remove_path, replace_path


def _format_of(path: str, fmt: str | None) -> str:
    return fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")


def _load(reader: DataFrameReader, path: str) -> DataFrame:
    """Load, with a readable error when the path is missing. Works for every file system that Spark reaches."""
    try:
        return reader.load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"expected input is missing: {path}") from error
        raise


def require_path(spark: SparkSession, path: str) -> str:
    """The path itself, or FileNotFoundError. Reads no data."""
    _load(spark.read.format("binaryFile"), path)
    return path


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str | None = None
) -> DataFrame:
    """Scan a table. With `schema` no inference pass is made; in a CSV, NaN is read as a missing value."""
    fmt = _format_of(path, fmt)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        # PERMISSIVE would turn a bad number into NULL silently.
        reader = reader.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", True)
    table = _load(reader, path)
    return nan_to_null(table) if fmt == "csv" else table


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        [F.nanvl(col_q(c), F.lit(None)).alias(c) if c in floats else col_q(c) for c in df.columns]
    )


def scan_pruned(spark: SparkSession, path: str, columns: list[str], schema=None, fmt: str | None = None) -> DataFrame:
    """Scan the named columns only; a name that the table lacks is an error. The pruning reaches the reader."""
    return read_table(spark, path, schema, fmt).select([col_q(c) for c in columns])


def schema_probe(df: DataFrame) -> DataFrame:
    """(ordinal, name, type) per column. Only the schema is read; no data."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, name string, type string")


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first `n` rows by an explicit order (a top-n, not a global sort)."""
    return df.orderBy([col_q(c) for c in order]).limit(n)


def write_table(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite") -> tuple[int, int]:
    """Write `df` and return (rows, columns); the rows are counted by the write job itself."""
    fmt = _format_of(path, fmt)
    seen = Observation("written")
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return seen.get["rows"], len(df.columns)


def write_verified(df: DataFrame, path: str, verify: Callable[[], None], fmt: str | None = None) -> tuple[int, int]:
    """As `write_table`, but `path` is replaced only when the rows are written and `verify` found nothing; else it stays as it was."""
    spark, fmt = df.sparkSession, _format_of(path, fmt)
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex[:12]}"
    try:
        written = write_table(df, staged, fmt)
        verify()
        replace_path(spark, staged, path)
    except Exception:
        remove_path(spark, staged)
        raise
    return written


def report_lines(df: DataFrame, template: list[tuple[str, str]], out: str = "line") -> DataFrame:
    """One text per row: each (label, column) pair of the template becomes `label: value`, joined with `, `."""
    parts = [F.concat(F.lit(label + ": "), F.coalesce(col_q(c).cast("string"), F.lit("None"))) for label, c in template]
    return df.select(F.concat_ws(", ", *parts).alias(out))


def write_lines(df: DataFrame, path: str, column: str = "line") -> None:
    df.selectExpr(f"{quoted(column)} AS value").write.mode("overwrite").text(path)
