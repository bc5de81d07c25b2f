"""Session settings, reliable materialisation and size-checked lookup joins."""

from __future__ import annotations

import atexit
import uuid
import warnings

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflow.functions.names import col_q

# A lookup side is broadcast only when its measured size is at most this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
_FOLDERS: set[str] = set()


def build_session(app: str = "urbanflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC; `conf` overrides single settings."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by `spark.checkpoint.dir`, else one below the session's warehouse, which executors share too."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    own_disk = warehouse.startswith("file:") or ":" not in warehouse
    if not named and own_disk and not context.master.startswith("local"):
        warnings.warn(f"set spark.checkpoint.dir to a folder that all executors share; {warehouse} may be local to each", stacklevel=2)
    context.setCheckpointDir(named or f"{warehouse}/checkpoints")


def _row_bytes(schema: T.StructType) -> Column | None:
    """Bytes of one row as an expression, or None when the schema holds a nested type."""
    fixed, parts = 16, []
    for field in schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(col_q(field.name)), F.lit(0)).cast("long") + F.lit(16))
        elif isinstance(field.dataType, T.AtomicType):
            fixed += 16
        else:
            return None
    total = F.lit(fixed).cast("long")
    for part in parts:
        total = total + part
    return total


def scratch_path(spark: SparkSession) -> str:
    """A new path under the checkpoint folder; what is written there is removed when the process ends."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/tables"
    if not _FOLDERS:
        atexit.register(release_tables, spark)
    _FOLDERS.add(folder)
    return f"{folder}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute `df` once into a table under the checkpoint folder and read it back.

    Losing an executor never recomputes its input, and later passes read only the columns they need.
    """
    return _written(df)[0]


def _written(df: DataFrame) -> tuple[DataFrame, int | None]:
    """The written table and its size in memory, measured by the write job itself."""
    spark = df.sparkSession
    path = scratch_path(spark)
    row_bytes, seen = _row_bytes(df.schema), None
    if row_bytes is not None:
        seen = Observation()
        df = df.observe(seen, F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes"))
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table, seen and seen.get["bytes"]


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def replace_path(spark: SparkSession, new: str, path: str) -> None:
    """Let what was written to `new` take the place of `path`."""
    remove_path(spark, path)
    source = spark._jvm.org.apache.hadoop.fs.Path(new)
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, spark._jvm.org.apache.hadoop.fs.Path(path)):
        raise OSError(f"{new} cannot be moved to {path}")


def drop_table(table: DataFrame) -> None:
    """Remove a table made by `materialize` once nothing lazy reads it any more."""
    remove_path(table.sparkSession, table.scratch_path)


def release_tables(spark: SparkSession) -> None:
    """Remove every table that this process has materialised; runs by itself when the process ends."""
    if spark.sparkContext._jsc is not None:
        for folder in _FOLDERS:
            remove_path(spark, folder)
    _FOLDERS.clear()


def join_lookup(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", max_bytes: int = BROADCAST_BYTES, *, unique: bool = False
) -> DataFrame:
    """Equi-join a large table with a lookup table.

    The lookup is computed once and measured as it is written. Within `max_bytes` it is broadcast, so the large side
    is neither shuffled nor sorted; beyond it, or when its size is unknown, the join is a shuffled one, in which
    adaptive execution splits hot keys. With `unique`, keys that the written lookup repeats are an error.
    """
    table, size = _written(right)
    if unique:
        repeated = table.dropna(subset=keys).groupBy(*map(col_q, keys)).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").head(1)
        if repeated:
            raise ValueError(f"the lookup repeats the key {repeated[0].asDict()}")
    small = size is not None and size <= max_bytes
    return left.join(F.broadcast(table) if small else table, keys, how)
