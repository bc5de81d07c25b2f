"""Expressions and reads that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words in the contracts that keep punctuation.
BLANK = r"[\x20\x09-\x0D]"
# Rows of an Arrow batch that are worked on at once; only the memory of a task depends on it.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(text), F.lit(""))


def words_of(text: Column) -> Column:
    """Runs of characters other than blanks."""
    return F.filter(F.split(text, BLANK + "+"), lambda w: w != "")


def as_row(docs: DataFrame, *columns: str) -> DataFrame:
    """All columns of `docs` as one struct `row`, and the named ones besides: what an operator adds clashes with none."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)


def running_sums(values: Column, block: int = 128) -> Column:
    """Sums of the values before each position, as an array one longer than `values`; linear in its length.

    Appending to one array copies it each time, so sums are built per block and then shifted by the blocks before.
    """
    empty = F.array().cast("array<bigint>")

    def scan(items: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("s"), empty.alias("o"))
        return F.aggregate(
            items, start, lambda a, x: F.struct((a["s"] + x).alias("s"), F.array_append(a["o"], a["s"]).alias("o"))
        )

    n = F.size(values)
    at = F.when(n > 0, F.sequence(F.lit(0), ((n - 1) / block).cast("int"))).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(at, lambda b: scan(F.slice(values, b * block + 1, F.lit(block))))

    def shift(parts: Column) -> Column:
        offsets = scan(F.transform(parts, lambda p: p["s"]))
        moved = F.transform(F.arrays_zip(parts.alias("p"), offsets["o"].alias("d")), lambda z: F.transform(z["p"]["o"], lambda v: v + z["d"]))
        return F.concat(F.flatten(moved), F.array(offsets["s"]))

    return shift(blocks)


def total_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: sizes the number of blocks."""
    return docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `SLICE_ROWS` rows, so that what a task makes of a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)
