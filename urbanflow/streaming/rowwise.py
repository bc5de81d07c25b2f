"""The enrichment of arriving rows.

Every step of it is a projection or a join with a finished lookup table, so it holds on an unbounded source without
state or watermarks: the same functions are called on the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from urbanflow.plans.enrichment import enrich_dataset


def enrich_stream(traffic: DataFrame, weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """`traffic` is a streaming table; both lookups are static."""
    if not traffic.isStreaming:
        raise ValueError("traffic must be a streaming table")
    return enrich_dataset(traffic, weather, holidays)


def write_available(df: DataFrame, path: str, state: str) -> StreamingQuery:
    """Process what has arrived, exactly once, and stop. `state` keeps the progress between runs."""
    writer = df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    return writer.option("checkpointLocation", state).start(path)
