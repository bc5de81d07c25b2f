"""Connected components of a graph too large for one task: labels spread along edges and along themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.session import drop_table, materialize


def components(edges: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """(node, label) for every node of the undirected edges (a, b); the label is the smallest node reachable.

    A round takes the smallest label among a node's neighbours and then that label's own label, so long chains shrink
    by half; each round's labels are written, and only sums over them reach the driver. `start` gives labels that are
    known to be right for a part of the edges. Hot nodes meet partial aggregates and splittable joins only. No edges
    give no rows.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = labels.select("node", F.least("node", "label").alias("label"))
    if start is not None:
        old = start.withColumnRenamed("label", "old")
        labels = labels.join(old, "node", "full_outer").select("node", F.least("label", "old").alias("label"))
    labels, last = materialize(labels), None
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        spread = labels.join(near, "node", "left").select("node", "label", F.least("label", "near").alias("next"))
        upper = labels.select(F.col("node").alias("next"), F.col("label").alias("top"))
        jumped = spread.join(upper, "next", "left").select("node", F.least("next", "top").alias("label"))
        better = materialize(jumped)
        # Labels only ever fall, so the sum of their hashes stands still when and only when they all do.
        seen = better.agg(F.sum(F.xxhash64("node", "label").cast("decimal(38,0)")).alias("s")).first()["s"]
        drop_table(labels)
        labels = better
        if seen == last:
            drop_table(both)
            return labels
        last = seen
