"""Regression trees, forests and boosting whose every knob is exact, grown as Spark jobs.

A node is split by histograms: per feature and value the rows, weights and weighted labels of the node. They add up, so
rows may lie anywhere, and rows of equal features count as one group with sums. A table of few enough different feature
vectors is grown from its groups, whatever its rows: a job draws the rows of every tree and sends sums per group, and
tasks grow trees side by side, over all models of a search, from those. In a table of more vectors, nodes of many rows
are split level by level, one job each: tasks send histograms, their sums choose the splits, and only splits reach the
driver; nodes of at most `CELLS_IN_TASK` cells are finished by one task each, which receives just their rows. Both ways
share the functions below and draw by hashes of rows and nodes, so they give the same trees.

A node is split if it has `least_split` rows, both children keep `least_leaf`, and its labels differ. Of the columns,
`columns` are drawn per node; if none of them splits it, more are drawn until one does. `tree_columns` restricts a whole
tree. A leaf has the value sum / (weight + penalty). Thresholds lie halfway between neighbouring values of the node.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.operators.positions import row_numbers
from urbanflow.session import drop_table, materialize

# Numbers (rows or groups times features) that one task may hold, trees that are grown by levels at a time, and values of
# a feature told apart; a feature of more values is cut at its quantiles.
CELLS_IN_TASK, TREES_IN_TASK, MAX_BINS = 1 << 23, 25, 1024
# Trees of each forest that a task grows from groups, and rows whose draws are summed by one task.
TREES_OF_GROUPS, ROWS_IN_DEAL = 10, 1 << 16
# Cells that are counted at once; only memory and speed depend on it.
AT_ONCE = 1 << 20
# Bytes of trees that are broadcast at once to score rows.
SCORED_BYTES = 16 << 20
_POISSON = np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 18)]))
TREE = "tree long, feature binary, threshold binary, left binary, value binary, rows binary"


@dataclass(frozen=True)
class Growth:
    """How a model is grown. `rate` is the step of boosting; without it trees are averaged. Unlimited `depth` is None."""

    trees: int = 1
    depth: int | None = None
    least_split: int = 2
    least_leaf: int = 1
    columns: object = None
    tree_columns: float = 1.0
    penalty: float = 0.0
    bootstrap: bool = False
    share: float = 1.0
    rate: float | None = None
    seed: int = 42
    max_bins: int = MAX_BINS


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _seed_of(growth: Growth, tree: int) -> np.uint64:
    return _mix(np.array([(growth.seed * 1_000_003 + tree) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0]


def row_weights(growth: Growth, tree: int, ids: np.ndarray) -> np.ndarray:
    """How often a tree sees each row: a Poisson draw for a bootstrap, a coin for a share, else once."""
    if not growth.bootstrap and growth.share >= 1:
        return np.ones(len(ids))
    chance = (_mix(ids ^ _seed_of(growth, tree)) >> np.uint64(11)) * 2.0**-53
    return np.searchsorted(_POISSON, chance, "right").astype(float) if growth.bootstrap else (chance < growth.share).astype(float)


def columns_per_node(growth: Growth, features: int) -> int:
    named = {"sqrt": features**0.5, "log2": np.log2(features), None: features}
    wanted = named[growth.columns] if growth.columns in named else float(growth.columns) * features
    return max(1, min(features, int(wanted + 1e-9)))


def tree_features(growth: Growth, tree: int, features: int) -> np.ndarray:
    """The columns that a tree may use."""
    if growth.tree_columns >= 1:
        return np.arange(features)
    order = np.argsort(_mix(np.arange(features, dtype=np.uint64) * np.uint64(0x5851F42D4C957F2D) ^ _seed_of(growth, tree) ^ np.uint64(0xC01)))
    return np.sort(order[: max(1, int(growth.tree_columns * features + 1e-9))])


def drawn_order(uids: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Per node, its allowed columns in the order in which they are tried."""
    chance = _mix(uids[:, None] ^ _mix(allowed.astype(np.uint64) + np.uint64(0xFEED))[None, :])
    return allowed[np.argsort(chance, axis=1)]


def child_uids(uids: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        pair = uids[:, None] * np.uint64(2) + np.array([1, 2], np.uint64)
    return _mix(pair).ravel()


@dataclass
class Values:
    """The values of each feature in ascending order, flat; of features cut at quantiles, the upper ends of the ranges."""

    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray
    exact: np.ndarray

    @staticmethod
    def of(parts: list[np.ndarray], exact: list[bool]) -> Values:
        size = np.array([len(p) for p in parts])
        return Values(np.concatenate(parts), np.cumsum(size) - size, size, np.array(exact))

    def bins(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint16)
        for f in range(x.shape[1]):
            own = self.flat[self.start[f] : self.start[f] + self.size[f]]
            out[:, f] = np.minimum(np.searchsorted(own, x[:, f], "left"), len(own) - 1)
        return out


def values_in_task(x: np.ndarray, max_bins: int, count: np.ndarray | None = None) -> Values:
    """The values of rows, or of groups of `count` rows each."""
    parts, exact = [], []
    for f in range(x.shape[1]):
        own = np.unique(x[:, f])
        exact.append(len(own) <= max_bins)
        if not exact[-1]:
            order = np.argsort(x[:, f], kind="stable")
            upto = np.cumsum(np.ones(len(x)) if count is None else count[order])
            ranks = np.ceil((upto[-1] - 1) * (np.arange(1, max_bins + 1) / max_bins))
            own = np.unique(x[order, f][np.searchsorted(upto, ranks, "right")])
        parts.append(own)
    return Values.of(parts, exact)


def values_of_table(rows: DataFrame, features: int, max_bins: int) -> Values:
    """The same from a table (x): distinct values where there are few enough, else quantiles; two aggregates."""
    cells = rows.select(F.posexplode("x").alias("f", "v"))
    shares = [float(i) / max_bins for i in range(1, max_bins + 1)]
    told = cells.groupBy("f").agg(F.approx_count_distinct("v", 0.02).alias("n"), F.percentile_approx("v", shares, 20 * max_bins).alias("q")).collect()
    few = [r["f"] for r in told if r["n"] <= 1.2 * max_bins]
    listed = cells.where(F.col("f").isin(few)).groupBy("f").agg(F.collect_set("v").alias("v")).collect() if few else []
    own = {r["f"]: np.unique(r["v"]) for r in listed}
    quantiles = {r["f"]: np.unique(r["q"]) for r in told}
    exact = [f in own and len(own[f]) <= max_bins for f in range(features)]
    return Values.of([own[f] if e else quantiles[f] for f, e in enumerate(exact)], exact)


@dataclass
class Splits:
    """Per node the best split so far; a gain of -inf is none."""

    gain: np.ndarray
    feature: np.ndarray
    last: np.ndarray  # the last bin that goes left
    threshold: np.ndarray

    @staticmethod
    def none(nodes: int) -> Splits:
        return Splits(np.full(nodes, -np.inf), np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros(nodes))


@dataclass
class Totals:
    rows: np.ndarray
    weight: np.ndarray
    total: np.ndarray
    square: np.ndarray

    def splittable(self, growth: Growth, depth: int) -> np.ndarray:
        spread = self.square - self.total**2 / np.maximum(self.weight, 1e-300)
        differ = spread > 1e-12 * np.maximum(self.square, 1e-300)
        enough = (self.rows >= growth.least_split) & (self.rows >= 2 * growth.least_leaf)
        return enough & differ & (growth.depth is None or depth < growth.depth)


def take_best(
    best: Splits, nodes: np.ndarray, feature: np.ndarray, hist: tuple[np.ndarray, ...], totals: Totals, values: Values, growth: Growth, there: np.ndarray | None = None
) -> None:
    """Improve the splits of `nodes`, each tried on a row of `feature`, by their histograms (rows, weights, sums), one after the other.

    `there` has the cells that the histograms are of, in ascending order, if they are not of all.
    """
    count, weight, total = hist
    if there is None:
        # Only values that a node has: of many small nodes, most have few.
        there = np.flatnonzero(count)
        count, weight, total = count[there], weight[there], total[there]
    tries = feature.shape[1]
    feature, nodes = feature.ravel(), np.repeat(nodes, tries)
    begin = np.cumsum(values.size[feature]) - values.size[feature]
    start = np.searchsorted(there, begin)
    node = np.repeat(np.arange(len(nodes)), np.diff(np.append(start, len(there))))

    def up_to(x: np.ndarray) -> np.ndarray:
        run = np.cumsum(x)
        return run - (run[start] - x[start])[node]

    left, wl, sl = up_to(count), up_to(weight), up_to(total)
    all_rows, all_weight, all_total = totals.rows[nodes], totals.weight[nodes], totals.total[nodes]
    good = (left >= growth.least_leaf) & (left <= (all_rows - growth.least_leaf)[node])
    wr, sr = all_weight[node] - wl, all_total[node] - sl
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(good, sl * sl / (wl + growth.penalty) + sr * sr / (wr + growth.penalty), -np.inf)
        top = np.maximum.reduceat(gain, start)
        near = gain >= (top - 1e-10 * np.abs(top))[node]
        first = np.minimum.reduceat(np.where(near, np.arange(len(gain)), len(gain)), start)
        top = top - all_total**2 / (all_weight + growth.penalty)
        # Of a node's features, the first that comes up to the best.
        each = top.reshape(-1, tries)
        most = each.max(axis=1)
        pick = (each >= (most - 1e-9 * np.abs(most))[:, None]).argmax(axis=1) + np.arange(len(each)) * tries
    nodes, feature, top, first, begin = nodes[pick], feature[pick], top[pick], first[pick], begin[pick]
    least = (-1e-9 if growth.penalty == 0 else 1e-12) * np.maximum(totals.square[nodes], 1e-300)
    known = np.where(np.isfinite(best.gain[nodes]), best.gain[nodes], 0)
    better = (top > least) & (top > best.gain[nodes] + 1e-9 * np.abs(known))
    if not better.any():
        return
    at, f, cell, begin = nodes[better], feature[better], first[better], begin[better]
    low = values.flat[values.start[f] + there[cell] - begin]
    high = values.flat[values.start[f] + there[cell + 1] - begin]
    middle = low + (high - low) / 2
    best.gain[at], best.feature[at], best.last[at] = top[better], f, there[cell] - begin
    best.threshold[at] = np.where(values.exact[f] & (middle < high), middle, low)


class Grown:
    """Nodes of a tree in order of levels: feature (-1: leaf), threshold, left child (the right one follows), value, rows."""

    def __init__(self) -> None:
        self.feature, self.threshold, self.left, self.value, self.rows = ([] for _ in range(5))

    def level(self, best: Splits, totals: Totals, growth: Growth, after: int) -> np.ndarray:
        """Add a level whose children are numbered from `after`; returns the places of the nodes that were split."""
        split = np.flatnonzero(np.isfinite(best.gain))
        left = np.full(len(best.gain), -1)
        left[split] = after + 2 * np.arange(len(split))
        self.feature.append(np.where(np.isfinite(best.gain), best.feature, -1).astype(np.int32))
        self.threshold.append(best.threshold)
        self.left.append(left.astype(np.int32))
        self.value.append(totals.total / np.maximum(totals.weight + growth.penalty, 1e-300))
        self.rows.append(totals.rows.astype(np.int64))
        return split

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(x) for x in (self.feature, self.threshold, self.left, self.value, self.rows))


def node_totals(at: np.ndarray, n: np.ndarray, w: np.ndarray, wy: np.ndarray, wyy: np.ndarray, nodes: int) -> Totals:
    return Totals(*(np.bincount(at, x, nodes) for x in (n, w, wy, wyy)))


def grow(bins: np.ndarray, values: Values, y: np.ndarray, w: np.ndarray, growth: Growth, tree: int, uid: np.uint64, depth: int = 0) -> tuple[np.ndarray, ...]:
    """A tree, or the part below the node `uid`, from all rows of weight above 0; arrays as of `Grown`."""
    return grow_groups(bins, values, (w > 0).astype(float), w, w * y, w * y * y, growth, tree, uid, depth)


def grow_groups(
    bins: np.ndarray, values: Values, n: np.ndarray, w: np.ndarray, wy: np.ndarray, wyy: np.ndarray, growth: Growth, tree: int, uid: np.uint64, depth: int = 0
) -> tuple[np.ndarray, ...]:
    """The same from groups of rows of equal features: per group its rows, and their weights, weighted labels and squares added up."""
    rows = np.flatnonzero(n > 0)
    columns, height, n, w, wy, wyy = bins[rows].T.ravel(), len(rows), n[rows], w[rows], wy[rows], wyy[rows]
    allowed = tree_features(growth, tree, bins.shape[1])
    tried = columns_per_node(growth, len(allowed))
    single, weighted, rows = bool((n == 1).all()), bool((w != n).any()), np.arange(height)
    at, uids, out, numbered = np.zeros(len(rows), np.int64), np.array([uid], np.uint64), Grown(), 1
    while len(uids):
        totals = node_totals(at, n, w, wy, wyy, len(uids))
        best, can = Splits.none(len(uids)), totals.splittable(growth, depth)
        # Rows of one group alone have the same features, so no further column tells them apart.
        several = np.bincount(at, minlength=len(uids)) > 1
        if can.any():
            order, slot = drawn_order(uids, allowed), 0
            while slot < len(allowed):
                nodes = np.flatnonzero(can if slot < tried else can & several & ~np.isfinite(best.gain))
                if not len(nodes):
                    break
                tries = min(tried - slot, max(1, AT_ONCE // max(len(at), 1))) if slot < tried else 1
                place = np.full(len(uids), -1)
                place[nodes] = np.arange(len(nodes))
                here = np.flatnonzero(place[at] >= 0)
                mine, feature = place[at[here]], order[nodes, slot : slot + tries]
                size = values.size[feature]
                start = (np.cumsum(size) - size.ravel()).reshape(size.shape)
                own, cells = rows[here], int(size.sum())
                cell = np.empty((feature.shape[1], len(here)), np.int64)
                for slot_cell, first, column in zip(cell, start.T, feature.T * height):
                    np.add(first[mine], columns[column[mine] + own], out=slot_cell)
                cell, there = cell.ravel(), None
                if cells > 2 * len(cell):
                    cell, there = _numbered(cell, cells)
                    cells = len(there)
                count = np.bincount(cell, None if single else np.tile(n[here], feature.shape[1]), cells)
                total = np.bincount(cell, np.tile(wy[here], feature.shape[1]), cells)
                weight = np.bincount(cell, np.tile(w[here], feature.shape[1]), cells) if weighted else count
                take_best(best, nodes, feature, (count, weight, total), totals, values, growth, there)
                slot += tries
        split = out.level(best, totals, growth, numbered)
        numbered += 2 * len(split)
        rank = np.full(len(uids), -1)
        rank[split] = np.arange(len(split))
        stay = rank[at] >= 0
        at, rows, n, w, wy, wyy = at[stay], rows[stay], n[stay], w[stay], wy[stay], wyy[stay]
        right = columns[best.feature[at] * height + rows] > best.last[at]
        at = 2 * rank[at] + right
        uids, depth = child_uids(uids[split]), depth + 1
    return out.arrays()


def _numbered(cell: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells' numbers among those that occur, and these in ascending order."""
    there = np.zeros(cells, bool)
    there[cell] = True
    there = np.flatnonzero(there)
    number = np.empty(cells, np.int32)
    number[there] = np.arange(len(there), dtype=np.int32)
    return number[cell], there


def tree_leaves(tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """The leaf that each row reaches."""
    feature, threshold, left = tree[:3]
    node = np.zeros(len(x), np.int64)
    inside = np.flatnonzero(feature[node] >= 0)
    while len(inside):
        at = node[inside]
        node[inside] = left[at] + (x[inside, feature[at]] > threshold[at])
        inside = inside[feature[node[inside]] >= 0]
    return node


def tree_values(tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    return tree[3][tree_leaves(tree, x)]


def _alike(growth: Growth, features: int) -> Growth:
    """Growths of which this is equal grow the same trees, but for where the depth and the rows to split end them."""
    columns = columns_per_node(growth, len(tree_features(growth, 0, features)))
    return replace(growth, trees=1, depth=None, least_split=0, columns=columns / max(features, 1))


def _farthest(growths: list[Growth]) -> Growth:
    """Of growths that are alike, the one whose trees hold those of all."""
    depths = [g.depth for g in growths]
    return replace(growths[0], depth=None if None in depths else max(depths), least_split=min(g.least_split for g in growths))


def ended_values(tree: tuple[np.ndarray, ...], growth: Growth) -> np.ndarray:
    """What `growth` says at each node of a tree that was grown farther: below a node that it does not split, the value of that node."""
    feature, _, left, value, rows = tree
    said, ended, begin, end, depth = value.copy(), rows < growth.least_split, 0, 1, 0
    while begin < end:
        inner = begin + np.flatnonzero(feature[begin:end] >= 0)
        ends = inner[ended[inner]] if growth.depth is None or depth < growth.depth else inner
        for child in (left[ends], left[ends] + 1):
            said[child], ended[child] = said[ends], True
        begin, end, depth = end, end + 2 * len(inner), depth + 1
    return said


def root_uid(growth: Growth, tree: int) -> np.uint64:
    return _mix(np.array([_seed_of(growth, tree)]) ^ np.uint64(0x7EE))[0]


def packed_tree(tree: int, arrays: tuple[np.ndarray, ...]) -> list:
    return [tree, *[a.tobytes() for a in arrays]]


def unpacked_tree(row: dict) -> tuple[np.ndarray, ...]:
    kinds = {"feature": np.int32, "threshold": np.float64, "left": np.int32, "value": np.float64, "rows": np.int64}
    return tuple(np.frombuffer(row[k], t) for k, t in kinds.items())


# Tables: rows are packed into blocks, each the numbers of one Arrow batch.
_BLOCK = "rows long, x binary, y binary, id binary, part binary"


def _told_apart(table: DataFrame, parts: list[str] | None) -> DataFrame:
    """(x, label, id, part) of an assembled table (features, label, and split if `parts` names its values).

    Rows are told apart by the hash of all they hold, so a draw does not depend on where a row lies.
    """
    others = [c for c in table.columns if c != "features"]
    x = vector_to_array("features")
    part = F.lit(0) if parts is None else F.coalesce(*[F.when(F.col("split") == p, F.lit(i)) for i, p in enumerate(parts)], F.lit(len(parts)))
    return table.select(x.alias("x"), "label", F.xxhash64(x, *[F.col(f"`{c}`") for c in others]).alias("id"), part.alias("part"))


def packed_rows(table: DataFrame) -> DataFrame:
    """Blocks of an assembled table, written."""
    rows = _told_apart(table, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                numbers = [batch["x"].flatten().to_numpy(zero_copy_only=False), batch["label"].to_numpy(zero_copy_only=False), batch["id"].to_numpy(), batch["part"].to_numpy().astype(np.int8)]
                columns = [pa.array([batch.num_rows]), *[pa.array([n.tobytes()], pa.binary()) for n in numbers]]
                yield pa.RecordBatch.from_arrays(columns, ["rows", "x", "y", "id", "part"])

    return materialize(rows.mapInArrow(run, _BLOCK))


def small_enough(table: DataFrame, features: int) -> bool:
    """Whether a task may hold the different feature vectors of an assembled table."""
    vectors = table.agg(F.approx_count_distinct(F.xxhash64(vector_to_array("features")), 0.02)).first()[0]
    return vectors * features <= CELLS_IN_TASK


@dataclass
class Groups:
    """The rows of equal features of a table.

    `table` has (g, x, told): the group's number, its features, and per part its rows, their mean label and the squares
    around it. `rows` are those of part 0 with their distance from the group's mean label, `base` is their mean label.
    """

    table: DataFrame
    rows: DataFrame
    count: int
    learned: int
    base: float

    @staticmethod
    def of(table: DataFrame, parts: list[str] | None = None) -> Groups:
        rows = _told_apart(table, parts).withColumn("label", F.coalesce("label", F.lit(float("nan"))))
        told = []
        for i in range(len(parts or [0])):
            own = F.when(F.col("part") == i, F.col("label"))
            told += [F.count(own).cast("double"), F.coalesce(F.avg(own), F.lit(0.0)), F.coalesce(F.var_pop(own) * F.count(own), F.lit(0.0))]
        found = materialize(rows.groupBy("x").agg(F.array(*told).alias("told")))
        # Numbers follow hashes, so that a range of them has its share of the rows.
        groups = materialize(row_numbers(found, [F.xxhash64("x"), F.col("x")], "g"))
        drop_table(found)
        n, mean = F.col("told")[0], F.col("told")[1]
        count, learned, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum(n), F.lit(0.0)), F.coalesce(F.sum(n * mean), F.lit(0.0))).first()
        known = F.broadcast(groups.select("x", "g", n.alias("n"), mean.alias("mean")))
        near = rows.where("part = 0").join(known, "x").select("g", "n", "id", (F.col("label") - F.col("mean")).alias("gap"))
        return Groups(groups, near, count, int(learned), total / learned if learned else 0.0)


def _draw_of(growth: Growth) -> tuple | None:
    """Models of equal ones draw the same rows for a tree; None draws nothing."""
    return (growth.seed, growth.bootstrap, growth.bootstrap or growth.share) if growth.bootstrap or growth.share < 1 else None


def _tasks(models: dict[str, Growth]) -> list[tuple[dict[str, Growth], int, int]]:
    """(models, first tree, trees) of every task: a boosted model each, the longest first, and chunks of the trees of all forests of a draw."""
    boosted = sorted((m for m, g in models.items() if g.rate is not None), key=lambda m: -models[m].trees)
    out = [({m: models[m]}, 0, models[m].trees) for m in boosted]
    shared: dict[object, dict[str, Growth]] = {}
    for name, growth in models.items():
        if growth.rate is None:
            shared.setdefault(_draw_of(growth) or name, {})[name] = growth
    for some in shared.values():
        most = max(g.trees for g in some.values())
        for first in range(0, most, TREES_OF_GROUPS):
            out.append(({m: g for m, g in some.items() if g.trees > first}, first, min(TREES_OF_GROUPS, most - first)))
    return out


_WORK = "task int, tree int, draw int, place long, a binary, b binary, c binary, d binary"


def _drawn(groups: Groups, draws: list[tuple[Growth, int]]) -> DataFrame:
    """(tree, draw, place, a, b, c, d): per tree and range of groups, from `place` on, the drawn rows, their weights, and their
    weighted distances from the group's mean label and squares of these.

    `draws` has a growth that draws so and a number of trees. A group of many rows is dealt to several tasks.
    """
    deals = groups.learned // ROWS_IN_DEAL + 1
    width = groups.count // deals + 1
    at = F.floor(F.col("g") / width) + F.pmod("id", F.floor(F.col("n") / ROWS_IN_DEAL) + 1)
    dealt = groups.rows.select("g", "id", "gap", F.pmod(at, F.lit(deals)).cast("int").alias("deal")).repartitionById(deals, "deal")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if b.num_rows]
        if not own:
            return
        g, ids, gap = (np.concatenate([b[c].to_numpy(zero_copy_only=False) for b in own]) for c in ("g", "id", "gap"))
        order = np.lexsort((gap, ids, g))
        g, ids, gap = g[order], ids[order].view(np.uint64), gap[order]
        ranges, begin = np.unique(g // width, return_index=True)
        ends = np.append(begin[1:], len(g))
        for draw, (growth, trees) in enumerate(draws):
            for tree in range(trees):
                w = row_weights(growth, tree, ids)
                n, s = w > 0, w * gap
                found = []
                for r, one, end in zip(ranges.tolist(), begin, ends):
                    part, size = g[one:end] - r * width, width
                    sums = [np.bincount(part, v[one:end], size) for v in (n, w, s, s * gap)]
                    found.append((tree, draw, r * width, *[v.astype(t).tobytes() for v, t in zip(sums, (np.int32, np.int32, np.float64, np.float64))]))
                types = (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], ["tree", "draw", "place", "a", "b", "c", "d"])

    return dealt.mapInArrow(run, _WORK.removeprefix("task int, "))


def _packed_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            cells = [batch["g"], *[batch[c].flatten() for c in ("x", "told")]]
            yield pa.RecordBatch.from_arrays([pa.array([c.to_numpy(zero_copy_only=False).tobytes()], pa.binary()) for c in cells], ["a", "b", "c"])


def _work(groups: Groups, models: dict[str, Growth], tasks: list[tuple[dict[str, Growth], int, int]]) -> DataFrame:
    """What each task of `_tasks` reads: all groups first (tree -1), then the draws of its trees in their order."""
    spark = groups.table.sparkSession
    numbers = spark.range(len(tasks)).select(F.col("id").cast("int").alias("task"))
    blocks = groups.table.mapInArrow(_packed_groups, "a binary, b binary, c binary").crossJoin(F.broadcast(numbers))
    work = blocks.select("task", F.lit(-1).alias("tree"), F.lit(-1).alias("draw"), F.lit(0).cast("long").alias("place"), "a", "b", "c", F.lit(b"").alias("d"))
    drawn = list(dict.fromkeys(d for d in map(_draw_of, models.values()) if d))
    if drawn:
        of = {d: [g for g in models.values() if _draw_of(g) == d] for d in drawn}
        sums = _drawn(groups, [(of[d][0], max(g.trees for g in of[d])) for d in drawn])
        wanted = []
        for task, (some, first, count) in enumerate(tasks):
            draw = _draw_of(next(iter(some.values())))
            wanted += [(task, tree, drawn.index(draw)) for tree in range(first, first + count)] if draw else []
        where = F.broadcast(spark.createDataFrame(wanted, "task int, tree int, draw int"))
        work = work.unionByName(sums.join(where, ["tree", "draw"]).select(work.columns))
    return work.repartitionById(len(tasks), "task").sortWithinPartitions("task", "tree", "place")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(column[i].as_py() for column in batch.columns)


@dataclass
class Held:
    """All groups of a table in a task: features, and per part rows, mean labels and squares around them."""

    x: np.ndarray
    told: np.ndarray

    @staticmethod
    def of(records: Iterator[tuple]) -> Held:
        blocks = list(records)
        g, x, told = (np.frombuffer(b"".join(r[k] for r in blocks), t) for k, t in ((4, np.int64), (5, np.float64), (6, np.float64)))
        order = np.argsort(g)
        return Held(x.reshape(len(g), -1)[order], told.reshape(len(g), -1, 3)[order])

    def drawn(self, records: Iterator[tuple]) -> list[np.ndarray]:
        out = [np.zeros(len(self.x)) for _ in range(4)]
        for record in records:
            for whole, data, kind in zip(out, record[4:], (np.int32, np.int32, np.float64, np.float64)):
                own = whole[record[3] :][: len(data) // np.dtype(kind).itemsize]
                own += np.frombuffer(data, kind)[: len(own)]
        return out


def _grown_models(held: Held, models: dict[str, Growth], first: int, count: int, base: float, records: Iterator[tuple]) -> Iterator[tuple[list[str], int, tuple]]:
    """(models, tree, arrays) of a task's trees from groups; boosted ones in turn, each on what the ones before it leave.

    Trees that differ only in where they end are grown once, as far as any of their models goes (see `ended_values`).
    """
    own = held.told[:, 0, 0] > 0
    x, (all_rows, mean, square) = held.x[own], held.told[own, 0].T
    bounds = {growth.max_bins for growth in models.values()}
    values = {b: values_in_task(x, b, all_rows) for b in bounds}
    bins = {b: v.bins(x) for b, v in values.items()}
    draws = groupby(records, key=lambda r: r[1])
    alike: dict[Growth, list[str]] = {}
    for name, growth in models.items():
        alike.setdefault(_alike(growth, x.shape[1]), []).append(name)
    y = mean - base
    for tree in range(first, first + count):
        n, w, s, q = all_rows, all_rows, np.zeros(len(x)), square
        if len(x) and _draw_of(next(iter(models.values()))):
            n, w, s, q = (v[own] for v in held.drawn(next(draws)[1]))
        for some in alike.values():
            names = [name for name in some if tree < models[name].trees]
            if not names:
                continue
            growth = _farthest([models[name] for name in names])
            b = growth.max_bins
            arrays = grow_groups(bins[b], values[b], n, w, s + w * y, q + y * (2 * s + w * y), growth, tree, root_uid(growth, tree))
            if growth.rate is not None:
                arrays = (*arrays[:3], arrays[3] * growth.rate, arrays[4])
                y = y - tree_values(arrays, x)
            yield names, tree, arrays


def grow_in_tasks(groups: Groups, growth: Growth) -> DataFrame:
    """The trees of one model from groups that fit a task, written."""
    models, base = {"m": growth}, groups.base
    tasks = _tasks(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task, records in groupby(_records(batches), key=lambda r: r[0]):
            some, first, count = tasks[task]
            rest = groupby(records, key=lambda r: r[1] < 0)
            held = Held.of(next(rest)[1])
            draws = next(rest, (False, iter(())))[1]
            for _, tree, arrays in _grown_models(held, some, first, count, base, draws):
                cells = packed_tree(tree, arrays)
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64() if i == 0 else pa.binary()) for i, c in enumerate(cells)], [c.split()[0] for c in TREE.split(", ")])

    return materialize(_work(groups, models, tasks).mapInArrow(run, TREE))


def errors_in_tasks(groups: Groups, trials: dict[int, dict[str, Growth]], parts: list[str], outputs: dict[str, list[str]]) -> DataFrame:
    """(trial, output, part, rows, squares): squared errors per part of the means of members, for every trial, in one job.

    `trials` maps a trial to its members; `outputs` maps an output to the members whose mean it is. Part 0 is learned from.
    Each task grows its trees and sums up what they say of all groups; no tree leaves its task. A boosted model has a task of its own.
    """
    models = {f"{trial}:{member}": growth for trial, members in trials.items() for member, growth in members.items()}
    base, tasks = groups.base, _tasks(models)

    def say(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task, records in groupby(_records(batches), key=lambda r: r[0]):
            some, first, count = tasks[task]
            rest = groupby(records, key=lambda r: r[1] < 0)
            held = Held.of(next(rest)[1])
            draws = next(rest, (False, iter(())))[1]
            totals = {name: np.zeros(len(held.x)) for name in some}
            for names, _, arrays in _grown_models(held, some, first, count, base, draws):
                leaves = tree_leaves(arrays, held.x)
                for name in names:
                    totals[name] += ended_values(arrays, some[name])[leaves]
            for name, total in totals.items():
                trial, _, member = name.partition(":")
                cells = [[int(trial)], [member], [first], [total.tobytes()], [held.told.tobytes() if first == 0 else b""]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()))], ["trial", "member", "first", "sums", "told"])

    def judge(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("member", "ascending"), ("first", "ascending")])
        trial = rows["trial"][0].as_py()
        told = np.frombuffer(next(t.as_py() for t, f in zip(rows["told"], rows["first"]) if f.as_py() == 0), np.float64).reshape(-1, len(parts), 3)
        said = {}
        for member, growth in trials[trial].items():
            total = sum(np.frombuffer(s.as_py(), np.float64) for m, s in zip(rows["member"], rows["sums"]) if m.as_py() == member)
            said[member] = base + (total / growth.trees if growth.rate is None else total)
        out = []
        for output, members in outputs.items():
            mean = sum(said[m] for m in members) / len(members)
            for i, part in enumerate(parts):
                n, label, square = told[told[:, i, 0] > 0, i].T
                gap = mean[told[:, i, 0] > 0] - label
                out += [(trial, output, part, int(n.sum()), float((square + n * gap**2).sum()))] if len(n) else []
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["trial", "output", "part", "rows", "squares"])

    sums = _work(groups, models, tasks).mapInArrow(say, "trial long, member string, first long, sums binary, told binary")
    return sums.groupBy("trial").applyInArrow(judge, "trial long, output string, part string, rows long, squares double")


@dataclass
class Top:
    """The upper nodes of a tree that is grown by levels: arrays as of `Grown`, and the open nodes with their uids and depth."""

    tree: int
    grown: Grown = field(default_factory=Grown)
    open: list[int] = field(default_factory=lambda: [0])
    uids: np.ndarray | None = None
    depth: int = 0
    numbered: int = 1
    # node -> (uid, depth) of nodes that a task finishes
    small: dict[int, tuple[int, int]] = field(default_factory=dict)


def _route(top_arrays: tuple[np.ndarray, ...] | None, x: np.ndarray) -> np.ndarray:
    """The node of the top that each row has reached."""
    node = np.zeros(len(x), np.int64)
    if top_arrays is not None:
        feature, threshold, left = top_arrays[:3]
        while True:
            known = node < len(feature)
            inside = np.flatnonzero(known)
            inside = inside[feature[node[inside]] >= 0]
            if not len(inside):
                break
            at = node[inside]
            node[inside] = left[at] + (x[inside, feature[at]] > threshold[at])
    return node


def _said_so_far(done: list[tuple], x: np.ndarray) -> np.ndarray:
    return sum((tree_values(t, x) for t in done), np.zeros(len(x)))


def grow_by_levels(blocks: DataFrame, rows: DataFrame, growth: Growth, features: int) -> DataFrame:
    """The trees of one model from blocks of any number, written; `rows` (x) has the same rows for the feature values.

    Averaged trees are grown `TREES_IN_TASK` at a time. Boosted trees are grown one by one; what they have said so far is
    written into the blocks every ten rounds.
    """
    spark = blocks.sparkSession
    values = values_of_table(rows, features, growth.max_bins)
    base = blocks.mapInArrow(_label_sums, "rows long, total double").agg((F.sum("total") / F.sum("rows")).alias("m")).first()["m"] or 0.0
    step = 1 if growth.rate is not None else TREES_IN_TASK
    tables, recent, current = [], [], blocks
    for first in range(0, growth.trees, step):
        trees = range(first, min(first + step, growth.trees))
        made = _grow_some(current, values, growth, trees, base, recent)
        tables.append(made)
        if growth.rate is not None:
            recent = [*recent, unpacked_tree(made.first().asDict())]
            if len(recent) == 10:
                current, recent = materialize(_less(current, recent, spark)), []
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def _label_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = [np.frombuffer(v, np.float64) for v in batch["y"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["rows"], pa.array([float(v.sum()) for v in y], pa.float64())], ["rows", "total"])


def _less(blocks: DataFrame, trees: list[tuple], spark) -> DataFrame:
    """The blocks with what the trees say taken off the labels."""
    shared = spark.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = []
            for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist()):
                label = np.frombuffer(y, np.float64)
                left.append((label - _said_so_far(shared.value, np.frombuffer(x, np.float64).reshape(len(label), -1))).tobytes())
            yield batch.set_column(batch.schema.get_field_index("y"), "y", pa.array(left, pa.binary()))

    return blocks.mapInArrow(run, _BLOCK)


def _grow_some(blocks: DataFrame, values: Values, growth: Growth, trees: range, base: float, recent: list[tuple]) -> DataFrame:
    spark = blocks.sparkSession
    features = len(values.size)
    limit = max(1, CELLS_IN_TASK // features)
    tops = [Top(t, uids=np.array([root_uid(growth, t)], np.uint64)) for t in trees]

    def state() -> dict:
        return {t.tree: (t.grown.arrays() if t.grown.feature else None, list(t.open)) for t in tops}

    def labels(x: np.ndarray, y: bytes) -> np.ndarray:
        return np.frombuffer(y, np.float64) - base - _said_so_far(recent, x)

    def histograms(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int], np.ndarray] = {}
            cells = int(values.size.sum())
            for batch in batches:
                for rows in batch.to_pylist():
                    y = np.frombuffer(rows["y"], np.float64)
                    x, ids = np.frombuffer(rows["x"], np.float64).reshape(len(y), -1), np.frombuffer(rows["id"], np.uint64)
                    y, bins = labels(x, rows["y"]), values.bins(x)
                    for tree, (arrays, open_nodes) in shared.value.items():
                        w, node = row_weights(growth, tree, ids), _route(arrays, x)
                        for n in open_nodes:
                            at = np.flatnonzero((node == n) & (w > 0))
                            if not len(at):
                                continue
                            total = sums.setdefault((tree, n), np.zeros((3, cells + 1)))
                            wa, ya = w[at], y[at]
                            total[:, -1] += (len(at), wa.sum(), (wa * ya * ya).sum())
                            for f in range(features):
                                cell = values.start[f] + bins[at, f]
                                for k, v in enumerate((None, wa, wa * ya)):
                                    total[k, :-1] += np.bincount(cell, v, cells)
            keys = list(sums)
            columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([sums[k].tobytes() for k in keys], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "hist"])

        return run

    def choose(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(h.as_py(), np.float64) for h in rows["hist"]).reshape(3, -1)
        tree, node = rows["tree"][0].as_py(), rows["node"][0].as_py()
        uid, depth = opened.value[tree, node]
        one = total[2, values.start[0] : values.start[0] + values.size[0]].sum()
        totals = Totals(*(np.array([v]) for v in (total[0, -1], total[1, -1], one, total[2, -1])))
        best = Splits.none(1)
        if total[0, -1] > limit and totals.splittable(growth, depth)[0]:
            allowed = tree_features(growth, tree, features)
            tried = columns_per_node(growth, len(allowed))
            order, slot = drawn_order(np.array([uid], np.uint64), allowed)[0], 0
            while slot < len(order) and (slot < tried or not np.isfinite(best.gain[0])):
                some = order[slot : slot + (tried if slot < tried else 1)]
                own = np.concatenate([np.arange(values.start[f], values.start[f] + values.size[f]) for f in some])
                take_best(best, np.array([0]), some[None, :], tuple(total[k, own] for k in range(3)), totals, values, growth)
                slot += len(some)
        numbers = [best.gain[0], best.threshold[0], totals.rows[0], totals.weight[0], totals.total[0], totals.square[0]]
        columns = [[tree], [node], [int(best.feature[0])], [int(best.last[0])], *[[float(v)] for v in numbers]]
        return pa.table([pa.array(c) for c in columns], ["tree", "node", "feature", "last", "gain", "threshold", "rows", "weight", "total", "square"])

    kinds = "tree long, node long, feature long, last long, gain double, threshold double, rows double, weight double, total double, square double"
    while any(t.open for t in tops):
        shared = spark.sparkContext.broadcast(state())
        opened = spark.sparkContext.broadcast({(t.tree, n): (int(u), t.depth) for t in tops for n, u in zip(t.open, t.uids)})
        chosen = blocks.mapInArrow(histograms(shared), "tree long, node long, hist binary").groupBy("tree", "node").applyInArrow(choose, kinds).collect()
        found = {(r["tree"], r["node"]): r for r in chosen}
        for t in tops:
            if not t.open:
                continue
            rows = [found.get((t.tree, n)) for n in t.open]
            get = lambda name, none=0.0: np.array([r[name] if r else none for r in rows])
            totals = Totals(get("rows"), get("weight"), get("total"), get("square"))
            best = Splits(get("gain", -np.inf), get("feature", -1), get("last", 0), get("threshold"))
            for place, (n, u) in enumerate(zip(t.open, t.uids)):
                if 0 < totals.rows[place] <= limit:
                    t.small[n] = (int(u), t.depth)
            split = t.grown.level(best, totals, growth, t.numbered)
            t.open = list(range(t.numbered, t.numbered + 2 * len(split)))
            t.numbered += 2 * len(split)
            t.uids, t.depth = child_uids(t.uids[split]), t.depth + 1
    final = {t.tree: (t.grown.arrays(), t.small) for t in tops}
    shared_final = spark.sparkContext.broadcast(final)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.to_pylist():
                y = np.frombuffer(rows["y"], np.float64)
                x, ids = np.frombuffer(rows["x"], np.float64).reshape(len(y), -1), np.frombuffer(rows["id"], np.uint64)
                y, out = labels(x, rows["y"]), []
                for tree, (arrays, small) in shared_final.value.items():
                    w, node = row_weights(growth, tree, ids), _route(arrays, x)
                    for n in small:
                        at = np.flatnonzero((node == n) & (w > 0))
                        if len(at):
                            out.append((tree, n, x[at].tobytes(), y[at].tobytes(), ids[at].tobytes()))
                if out:
                    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["tree", "node", "x", "y", "id"])

    def finish(rows: pa.Table) -> pa.Table:
        tree, node = rows["tree"][0].as_py(), rows["node"][0].as_py()
        uid, depth = shared_final.value[tree][1][node]
        joined = {k: b"".join(v.as_py() for v in rows[k]) for k in ("x", "y", "id")}
        y, ids = np.frombuffer(joined["y"], np.float64), np.frombuffer(joined["id"], np.uint64)
        x = np.frombuffer(joined["x"], np.float64).reshape(len(y), -1)
        order = np.lexsort((y, ids))
        x, y, ids = x[order], y[order], ids[order]
        arrays = grow(values.bins(x), values, y, row_weights(growth, tree, ids), growth, tree, np.uint64(uid), depth)
        return pa.table([pa.array(c, t) for c, t in zip([[v] for v in (tree, node, *(a.tobytes() for a in arrays))], (pa.int64(), pa.int64(), *[pa.binary()] * 5))],
                        ["tree", "node", "feature", "threshold", "left", "value", "rows"])

    parts = blocks.mapInArrow(deal, "tree long, node long, x binary, y binary, id binary").groupBy("tree", "node").applyInArrow(
        finish, "tree long, node long, feature binary, threshold binary, left binary, value binary, rows binary"
    )

    def whole(rows: pa.Table) -> pa.Table:
        """A tree from its top and the parts below: the root of a part takes the place of its node, other nodes follow."""
        tree = rows["tree"][0].as_py()
        arrays = [a.copy() for a in shared_final.value[tree][0]]
        for row in rows.sort_by("node").to_pylist():
            if row["node"] < 0:
                continue
            part = [a.copy() for a in unpacked_tree(row)]
            shift = len(arrays[0]) - 1
            part[2] = np.where(part[2] >= 0, part[2] + shift, -1).astype(np.int32)
            for k in range(5):
                arrays[k][row["node"]] = part[k][0]
                arrays[k] = np.concatenate([arrays[k], part[k][1:]])
        if growth.rate is not None:
            arrays[3] = arrays[3] * growth.rate
        return pa.table([pa.array([v], t) for v, t in zip(packed_tree(tree, arrays), (pa.int64(), *[pa.binary()] * 5))], [c.split()[0] for c in TREE.split(", ")])

    empty = b""
    roots = spark.createDataFrame([(t, -1, *[empty] * 5) for t in trees], parts.schema)
    return materialize(parts.unionByName(roots).groupBy("tree").applyInArrow(whole, TREE))


@dataclass
class Trees:
    """A grown model: its trees as a written table, and the mean label that they start from."""

    table: DataFrame
    growth: Growth
    base: float
    prediction: str = "prediction"

    def transform(self, rows: DataFrame) -> DataFrame:
        """`rows` (features, ...) with the prediction. Where few feature vectors repeat, each is scored once.

        The rows are read several times, so they have to be the same each time, as those of a written table are.
        """
        one = rows.select("features").first()
        if one is None or not small_enough(rows, one["features"].size):
            return self._scored(rows.withColumn("__x", vector_to_array("features"))).drop("__x")
        x = vector_to_array("features")
        vectors = materialize(self._scored(materialize(rows.select(x.alias("__x")).distinct())))
        changed = F.raise_error(F.lit("the rows changed while they were scored")).cast("double")
        known = vectors.withColumnRenamed(self.prediction, "__p").withColumn("__known", F.lit(True))
        found = rows.withColumn("__x", x).join(F.broadcast(known), "__x", "left")
        return found.withColumn(self.prediction, F.when(F.col("__known"), F.col("__p")).otherwise(changed)).drop("__x", "__p", "__known")

    def _scored(self, rows: DataFrame) -> DataFrame:
        """`rows` (__x, ...) with the prediction; trees are broadcast `SCORED_BYTES` at a time."""
        total, first = F.lit(0.0), True
        for chunk in _tree_chunks(self.table):
            if not first:
                rows = materialize(rows.withColumn("__said", total))
                total = F.col("__said")
            total, first = total + _said(rows, chunk), False
        mean = total / F.lit(float(max(self.growth.trees, 1))) if self.growth.rate is None else total
        return rows.withColumn(self.prediction, F.lit(self.base) + mean).drop("__said")

    def nodes(self) -> DataFrame:
        """(tree, node, feature, threshold, left, right, value, rows): one row per node; a leaf has no feature.

        The value is what the node predicts, or in boosting what it adds.
        """
        base = self.base if self.growth.rate is None else 0.0

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    feature, threshold, left, value, rows = unpacked_tree(row)
                    n = len(feature)
                    columns = [
                        pa.array(np.full(n, row["tree"])), pa.array(np.arange(n)), pa.array(feature, mask=feature < 0), pa.array(threshold, mask=feature < 0),
                        pa.array(left.astype(np.int64), mask=feature < 0), pa.array(left.astype(np.int64) + 1, mask=feature < 0), pa.array(value + base), pa.array(rows),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "feature", "threshold", "left", "right", "value", "rows"])

        return self.table.mapInArrow(run, "tree long, node long, feature int, threshold double, left long, right long, value double, rows long")


def _tree_chunks(trees: DataFrame) -> Iterator[list[tuple]]:
    chunk, size = [], 0
    for row in trees.toLocalIterator():
        tree = unpacked_tree(row.asDict())
        chunk.append(tree[:4])
        size += sum(a.nbytes for a in tree)
        if size >= SCORED_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _said(rows: DataFrame, trees: list[tuple]):
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def say(x: pd.Series) -> pd.Series:
        return pd.Series(_said_so_far(shared.value, np.stack(x.to_numpy())) if len(x) else np.empty(0))

    return say(F.col("__x"))


def fit_trees(growth: Growth, train: DataFrame, prediction: str = "prediction") -> Trees:
    """Grow a model on an assembled table (features, label, ...)."""
    one = train.select("features").first()
    if one is None:
        raise ValueError("no rows to learn from")
    features = one["features"].size
    if small_enough(train, features):
        groups = Groups.of(train)
        trees, base = grow_in_tasks(groups, growth), groups.base
        drop_table(groups.table)
        return Trees(trees, growth, float(base), prediction)
    blocks = packed_rows(train)
    base = blocks.mapInArrow(_label_sums, "rows long, total double").agg((F.sum("total") / F.sum("rows")).alias("m")).first()["m"]
    trees = grow_by_levels(blocks, train.select(vector_to_array("features").alias("x")), growth, features)
    drop_table(blocks)
    return Trees(trees, growth, float(base), prediction)
