"""k-means on score columns, its elbow curve, centres and profiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.functions.names import col_q
from urbanflow.operators.bins import box_stats_unpivot
from urbanflow.operators.reduce import vector_of
from urbanflow.session import drop_table, materialize

SEED = 42
# From so many rows on, a pass costs more than a job's start, and the 150 bytes a row that a fit of MLlib caches count:
# fits follow one another and only choose the first centres, and the centres of all k move together.
LARGE = 2_000_000
# Points of a block; its distances stay in a processor's cache.
BLOCK = 8192
# The first moves are long; from this one on, points that no move can reach are set aside.
FIRST_ASIDE = 10
# Points are set aside for centres that go no further than this many of their last moves.
MOVES_AHEAD = 4


def _points(df: DataFrame, columns: list[str]) -> DataFrame:
    """The score columns alone, written once, as vectors: every iteration of every fit reads them again."""
    return materialize(df.select(*map(col_q, columns))).select(vector_of(columns).alias("features"))


def _fit(points: DataFrame, k: int, seed: int, max_iter: int) -> KMeansModel:
    solver = "auto" if max_iter else "block"  # all solvers choose the same first centres, this one fastest
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster", solver=solver).fit(points)


def kmeans_elbow(
    df: DataFrame, columns: list[str], ks: range = range(1, 11), seed: int = SEED, max_iter: int = 300, parallelism: int = 1
) -> DataFrame:
    """(k, inertia): the sum of squared distances to the nearest centre, `parallelism` fits at a time.

    k = 1 needs no fit: it is the number of rows times the total variance. On a large table MLlib chooses the first centres only,
    one k after the other; then a pass over the points moves the centres of every k that has not converged, by MLlib's rules.
    """
    table = materialize(df.select(*map(col_q, columns)))
    points = table.select(vector_of(columns).alias("features"))
    several = [k for k in dict.fromkeys(ks) if k != 1]
    large = bool(several) and table.count() >= LARGE

    def inertia(k: int) -> float:
        if k == 1:
            parts = [F.count(F.lit(1)) * F.var_pop(col_q(c)) for c in columns]
            return float(table.agg(sum(parts[1:], parts[0]).alias("i")).first()["i"])
        return float(_fit(points, k, seed, max_iter).summary.trainingCost)

    if large:
        starts = {k: np.array([list(c) for c in _fit(points, k, seed, 0).clusterCenters()], dtype=float) for k in several}
        found = _inertias(table.select(*[col_q(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]), starts, max_iter)
        costs = [found[k] if k in found else inertia(k) for k in ks]
    else:
        with ThreadPoolExecutor(parallelism) as pool:
            costs = list(pool.map(inheritable_thread_target(df.sparkSession)(inertia), ks))
    return df.sparkSession.createDataFrame(list(zip(ks, costs)), "k int, inertia double")


_BLOCKS = "k int, x binary, sums binary"


def _rows(*rows: tuple) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.binary(), pa.binary())
    return pa.record_batch([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=["k", "x", "sums"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points as blocks for every k (k is NULL), a column of the table after the other."""
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            x = np.array([column.to_numpy(zero_copy_only=False) for column in batch.slice(first, BLOCK).columns])
            yield _rows((None, x.tobytes(), None))


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest centre (of equal ones the first) and the squared distances to it and to the second nearest."""
    label = np.zeros(x.shape[1], dtype=np.intp)
    best, second = np.full(x.shape[1], np.inf), np.full(x.shape[1], np.inf)
    far, gap = np.empty(x.shape[1]), np.empty(x.shape[1])
    for j, center in enumerate(centers):
        far.fill(0)
        for row, at in zip(x, center):
            np.subtract(row, at, out=gap)
            np.multiply(gap, gap, out=gap)
            np.add(far, gap, out=far)
        np.copyto(label, j, where=far < best)
        np.maximum(far, best, out=gap)
        np.minimum(second, gap, out=second)
        np.minimum(best, far, out=best)
    return label, best, second


def _sums(x: np.ndarray, centers: np.ndarray, label: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Per centre: points, squared distances, and the sums of the points less the centre."""
    n = np.bincount(label, minlength=len(centers))
    total = np.array([np.bincount(label, weights=row, minlength=len(centers)) for row in x])
    return np.vstack([n, np.bincount(label, weights=best, minlength=len(centers)), total - n * centers.T])


def _assigned(centers: dict[int, np.ndarray], reach: dict[int, float] | None = None) -> Callable:
    """A task's sums of its points per k and centre, in one row. With `reach`, only points whose nearest centre stays the same
    while no centre goes further than that are summed; the others are handed on, as blocks of their k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros((2 + c.shape[1], len(c))) for k, c in centers.items()}
        kept = {k: [] for k in centers}
        for batch in batches:
            for of, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                for k in centers if of is None else centers.keys() & {of}:
                    x = np.frombuffer(block.as_buffer()).reshape(centers[k].shape[1], -1)
                    label, best, second = _nearest(x, centers[k])
                    if reach is not None:
                        margin = np.sqrt(second) * (1 - 1e-9) - np.sqrt(best)
                        near = margin <= 2 * reach[k]
                        kept[k].append(x[:, near])
                        x, label, best = x[:, ~near], label[~near], best[~near]
                        if sum(part.shape[1] for part in kept[k]) >= BLOCK:
                            yield _rows((k, np.hstack(kept[k]).tobytes(), None))
                            kept[k] = []
                    sums[k] += _sums(x, centers[k], label, best)
        rest = [(k, np.hstack(parts).tobytes(), None) for k, parts in kept.items() if parts]
        yield _rows(*rest, (None, None, np.concatenate([s.ravel() for s in sums.values()]).tobytes()))

    return run


def _added(done: DataFrame, centers: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The sums of all tasks per k."""
    size = sum(c.size + 2 * len(c) for c in centers.values())
    total = sum((np.frombuffer(row["sums"]) for row in done.where("sums IS NOT NULL").select("sums").collect()), np.zeros(size))
    cuts = np.cumsum([c.size + 2 * len(c) for c in centers.values()])[:-1]
    return {k: part.reshape(-1, len(c)) for (k, c), part in zip(centers.items(), np.split(total, cuts))}


def _seen_from(sums: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The sums of the same points, taken from other centres."""
    n, squares, total, step = sums[0], sums[1], sums[2:], (new - old).T
    return np.vstack([n, squares - 2 * (step * total).sum(axis=0) + n * (step**2).sum(axis=0), total - n * step])


def _longest(steps: np.ndarray) -> float:
    return float(np.sqrt((steps**2).sum(axis=1).max()))


def _inertias(points: DataFrame, centers: dict[int, np.ndarray], max_iter: int) -> dict[int, float]:
    """The inertia per k when its centres have come to rest, or after `max_iter` moves.

    While the centres of a k stay within `reach` of where they were (`origin`), a point that is nearer to its centre than to
    any other by twice that keeps it. Such points count by their sums, which is exact; only the others are read again.
    """
    tol = KMeans().getTol()
    blocks = open_blocks = materialize(points.mapInArrow(_pack, _BLOCKS))
    costs = dict.fromkeys(centers, 0.0)
    origin, aside, reach, moved = dict(centers), {}, dict.fromkeys(centers, 0.0), {}
    for step in range(max_iter):
        if not centers:
            break
        if step >= FIRST_ASIDE and any(_longest(c - origin[k]) > reach[k] for k, c in centers.items()):
            if open_blocks is not blocks:
                drop_table(open_blocks)
            origin, reach = dict(centers), {k: MOVES_AHEAD * moved[k] for k in centers}
            open_blocks = materialize(blocks.select("k", "x").mapInArrow(_assigned(centers, reach), _BLOCKS))
            aside = _added(open_blocks, centers)
        parts = open_blocks.where("x IS NOT NULL").select("k", "x").mapInArrow(_assigned(centers), _BLOCKS)
        sums = _added(parts, centers)
        for k, old in list(centers.items()):
            if k in aside:
                sums[k] = sums[k] + _seen_from(aside[k], origin[k], old)
            n, squares, total = sums[k][0], sums[k][1], sums[k][2:]
            costs[k] = float(squares.sum())
            centers[k] = old + np.divide(total, n, out=np.zeros_like(total), where=n > 0).T
            moved[k] = _longest(centers[k] - old)
            if moved[k] <= tol:
                del centers[k]
    if open_blocks is not blocks:
        drop_table(open_blocks)
    drop_table(blocks)
    return costs


def kmeans_fit(df: DataFrame, columns: list[str], k: int = 2, seed: int = SEED, max_iter: int = 300) -> KMeansModel:
    return _fit(_points(df, columns), k, seed, max_iter)


def kmeans_assign(df: DataFrame, columns: list[str], model: KMeansModel, out: str = "Cluster") -> DataFrame:
    """Append the cluster of each row, numbered by ascending centre, so that runs are comparable.

    The label is computed on the row itself, so nothing is matched by position.
    """
    scored = model.transform(df.withColumn("features", vector_of(columns)))
    order = _by_center(model)
    numbers = F.array(*[F.lit(order.index(i)) for i in range(len(order))])
    return scored.withColumn("cluster", numbers[F.col("cluster")]).withColumnRenamed("cluster", out).drop("features")


def _by_center(model: KMeansModel) -> list[int]:
    """The model's clusters in the ascending order of their centres."""
    centers = [tuple(map(float, c)) for c in model.clusterCenters()]
    return sorted(range(len(centers)), key=lambda i: centers[i])


def cluster_centers(df: DataFrame, columns: list[str], model: KMeansModel) -> DataFrame:
    """(Cluster, one column per score): the centres, ascending, in the space that was clustered."""
    centers = model.clusterCenters()
    rows = [(number, *map(float, centers[i])) for number, i in enumerate(_by_center(model))]
    return df.sparkSession.createDataFrame(rows, ", ".join(["Cluster int", *[f"`{c}` double" for c in columns]]))


def cluster_profile(df: DataFrame, values: list[str], cluster: str = "Cluster", **options: int) -> DataFrame:
    """Box statistics of the original columns in each cluster."""
    return box_stats_unpivot(df, cluster, values, **options)
