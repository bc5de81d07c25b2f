"""CSV files with rows that cannot be read: kept apart with file and reason, and counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflow.functions.names import col_q, quoted
from urbanflow.session import drop_table, materialize
from urbanflow.sources.tables import nan_to_null, require_path

_RAW = "__record"


def _as_schema(spark: SparkSession, schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _reason(schema: T.StructType) -> Column:
    """Why a record does not fit: too many or too few values, or the first column whose value has another type."""
    texts = ", ".join([f"{quoted(f.name)} STRING" for f in schema.fields] + ["`__more` STRING"])
    parsed = F.from_csv(F.col("record"), texts)
    reason = F.when(parsed["__more"].isNotNull(), F.lit(f"more than {len(schema.fields)} values"))
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            value = parsed.getField(f.name)
            bad = value.isNotNull() & value.try_cast(f.dataType).isNull()
            reason = reason.when(bad, F.concat(F.lit(f"{f.name}: "), value, F.lit(f" is no {f.dataType.simpleString()}")))
    return reason.otherwise(F.lit(f"fewer than {len(schema.fields)} values"))


def read_quarantined(spark: SparkSession, path: str, schema: T.StructType | str, rejects: str | None = None) -> tuple[DataFrame, int]:
    """(rows, number of rejected records) of CSV files with a header; the files are read once.

    With a folder `rejects`, records that do not fit the schema are appended there as (file, record, reason); without one,
    any such record is an error that shows the first ones.
    """
    require_path(spark, path)
    fields = _as_schema(spark, schema)
    given = T.StructType([*fields.fields, T.StructField(_RAW, T.StringType())])
    reader = spark.read.schema(given).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW)
    seen = materialize(reader.csv(path).select("*", F.col("_metadata.file_path").alias("__file")))
    bad = seen.where(F.col(_RAW).isNotNull()).select(F.col("__file").alias("file"), F.col(_RAW).alias("record"))
    bad = bad.select("file", "record", _reason(fields).alias("reason"))
    count = bad.count()
    if count and rejects is None:
        first = [f"{r['record']!r} ({r['reason']})" for r in bad.orderBy("file", "record").limit(5).collect()]
        drop_table(seen)
        raise ValueError(f"{count} records of {path} cannot be read: {'; '.join(first)}")
    if count:
        bad.write.mode("append").parquet(rejects)
    rows = seen.where(F.col(_RAW).isNull()).select([col_q(f.name) for f in fields.fields])
    return nan_to_null(rows), count
