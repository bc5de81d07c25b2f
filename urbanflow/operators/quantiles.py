"""Exact quantiles with linear interpolation, without holding a group in one task.

The built-in exact percentile keeps every distinct value of a group in one aggregation buffer. Here values are
counted first, and a group is ordered only when it has at most `CELL_ROWS` rows. The order statistics of a larger
group are first bracketed with mergeable sketches, one scan per round, until the bracket holds few enough rows;
only the rows inside the bracket are then counted and ordered. The sketch decides how much is ordered, never the
result: ranks are counted exactly, and a bracket that missed its rank would be an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanflow.functions.names import col_q
from urbanflow.functions.numbers import present
from urbanflow.operators.aggregates import with_keys
from urbanflow.session import join_lookup, materialize

# Rows of one group that a single task may order.
CELL_ROWS = 2_000_000
# Each round cuts a bracket to about 3/GRID of its rows; the sketch error is 1/(20*GRID).
GRID = 1000
MAX_ROUNDS = 6


def _interpolate(low: Column, high: Column, fraction: Column) -> Column:
    return F.when(fraction > 0, low + (F.coalesce(high, low) - low) * fraction).otherwise(low)


def exact_quantiles(
    df: DataFrame,
    groups: list[str],
    value: str,
    probs: dict[str, float],
    cell_rows: int = CELL_ROWS,
    grid: int = GRID,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Groups, `n` (present values) and one column per entry of `probs`. Missing keys and values are left out.

    `sizes` (groups and `n`, as a written table) saves the counting pass when the caller has it.
    """
    keys = [f"__g{i}" for i in range(len(groups))]
    data = with_keys(df, groups).select(*[col_q(g).alias(k) for g, k in zip(groups, keys)], col_q(value).cast("double").alias("__v"))
    data = data.where(present(F.col("__v")))
    if sizes is None:
        sizes = materialize(data.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    else:
        sizes = sizes.select(*[col_q(g).alias(k) for g, k in zip(groups, keys)], "n")
    largest = sizes.agg(F.max("n")).first()[0] or 0
    wide = _ordered(data, keys, probs) if largest <= cell_rows else _bracketed(data, keys, sizes, probs, cell_rows, grid)
    return wide.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], "n", *[F.col(p) for p in probs])


def _ordered(data: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """All groups are small: count the values, order each group once, read every order statistic off it."""
    counts = data.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"))
    upto = W.partitionBy(*keys).orderBy("__v").rowsBetween(W.unboundedPreceding, 0)
    ranked = counts.select(
        *keys, "__v", F.sum("__n").over(upto).alias("__cum"), F.sum("__n").over(W.partitionBy(*keys)).alias("n")
    )
    steps = []
    for name, p in probs.items():
        rank = F.floor((F.col("n") - 1) * F.lit(p)) + 1
        steps.append(F.min(F.when(F.col("__cum") >= rank, F.col("__v"))).alias("low_" + name))
        steps.append(F.min(F.when(F.col("__cum") >= rank + 1, F.col("__v"))).alias("high_" + name))
    grouped = ranked.groupBy(*keys).agg(F.max("n").alias("n"), *steps)
    out = [*map(F.col, keys), F.col("n")]
    for name, p in probs.items():
        h = (F.col("n") - 1) * F.lit(p)
        out.append(_interpolate(F.col("low_" + name), F.col("high_" + name), h - F.floor(h)).alias(name))
    return grouped.select(out).where("n IS NOT NULL")


def _bracketed(
    data: DataFrame, keys: list[str], sizes: DataFrame, probs: dict[str, float], cell_rows: int, grid: int
) -> DataFrame:
    constant = not keys
    if constant:
        keys, data, sizes = ["__g"], data.withColumn("__g", F.lit(0)), sizes.withColumn("__g", F.lit(0))
    names = list(probs)
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(probs[p])).alias("p")) for i, p in enumerate(names)]))
    h = (F.col("n") - 1) * F.col("q.p")
    targets = sizes.withColumn("q", wanted).select(
        *keys,
        F.col("q.i").alias("i"),
        "n",
        (F.floor(h) + 1).alias("rank"),
        (h - F.floor(h)).alias("fraction"),
        F.lit(float("-inf")).alias("lo"),
        F.lit(float("inf")).alias("hi"),
        F.col("n").alias("expected"),
    )
    targets = materialize(targets)
    for _ in range(MAX_ROUNDS):
        if targets.agg(F.max("expected")).first()[0] <= cell_rows:
            break
        targets = materialize(_narrow(data, keys, targets, cell_rows, grid))
    v, lo, hi = F.col("__v"), F.col("lo"), F.col("hi")
    # One row per distinct value inside the bracket, plus one row (NULL) that counts everything below it.
    near = join_lookup(data, targets, keys, "inner").where(v <= hi)
    carried = [*keys, "i", "n", "rank", "fraction"]
    cells = near.groupBy(*carried, F.when(v >= lo, v).alias("__cell")).agg(F.count(F.lit(1)).alias("__n"))
    upto = W.partitionBy(*keys, "i").orderBy(F.col("__cell").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    ranked = cells.withColumn("__cum", F.sum("__n").over(upto))
    cell, cum, rank = F.col("__cell"), F.col("__cum"), F.col("rank")
    stats = ranked.groupBy(*carried).agg(
        F.min(F.when(cell.isNotNull() & (cum >= rank), cell)).alias("low"),
        F.min(F.when(cell.isNotNull() & (cum >= rank + 1), cell)).alias("high"),
        F.coalesce(F.max(F.when(cell.isNull(), F.col("__n"))), F.lit(0)).alias("below"),
        F.max(cum).alias("covered"),
    )
    sound = (F.col("below") < rank) & (F.col("covered") >= F.least(rank + 1, F.col("n")))
    exact = F.when(sound, _interpolate(F.col("low"), F.col("high"), F.col("fraction"))).otherwise(
        F.raise_error(F.lit("a quantile bracket missed its rank")).cast("double")
    )
    stats = stats.withColumn("__q", exact)
    return stats.groupBy(*keys, "n").agg(
        *[F.max(F.when(F.col("i") == i, F.col("__q"))).alias(name) for i, name in enumerate(names)]
    )


def _narrow(data: DataFrame, keys: list[str], targets: DataFrame, cell_rows: int, grid: int) -> DataFrame:
    """One scan: count the rows below and inside each bracket, sketch the inside, and cut the bracket around the rank."""
    v, lo, hi = F.col("__v"), F.col("lo"), F.col("hi")
    inside = (v >= lo) & (v <= hi)
    # Brackets that are small enough already are left alone and not sketched again.
    open_targets = targets.where(F.col("expected") > cell_rows)
    scan = (
        join_lookup(data, open_targets.select(*keys, "i", "lo", "hi"), keys, "inner")
        .groupBy(*keys, "i")
        .agg(
            F.sum((v < lo).cast("long")).alias("below"),
            F.sum(inside.cast("long")).alias("inside"),
            F.percentile_approx(F.when(inside, v), [j / grid for j in range(1, grid)], 20 * grid).alias("marks"),
        )
    )
    joined = targets.join(scan, [*keys, "i"], "left")
    at = (F.col("rank") - F.col("below")) / F.col("inside") * F.lit(grid)
    first, last = F.floor(at) - 1, F.ceil(at) + 1
    new_lo = F.when(first >= 1, F.element_at("marks", F.greatest(first, F.lit(1)).cast("int"))).otherwise(lo)
    new_hi = F.when(last <= grid - 1, F.element_at("marks", F.least(last, F.lit(grid - 1)).cast("int"))).otherwise(hi)
    todo = F.col("inside").isNotNull() & (F.col("inside") > cell_rows)
    narrowed = joined.select(
        *keys, "i", "n", "rank", "fraction", "expected", "inside", lo, hi,
        F.when(todo, new_lo).otherwise(lo).alias("lo2"),
        F.when(todo, new_hi).otherwise(hi).alias("hi2"),
    )
    lo2, hi2 = F.col("lo2"), F.col("hi2")
    # A bracket of one value, or one that ties keep from shrinking, is done: equal values are one cell anyway.
    done = (lo2 == hi2) | ((lo2 == lo) & (hi2 == hi))
    left = F.ceil(F.col("inside") * F.lit(4.0 / grid))
    expected = F.when(F.col("inside").isNull(), F.col("expected")).when(done, F.lit(1)).otherwise(left)
    return narrowed.select(
        *keys, "i", "n", "rank", "fraction", lo2.alias("lo"), hi2.alias("hi"), expected.cast("long").alias("expected")
    )


def approx_quantiles(df: DataFrame, groups: list[str], value: str, probs: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """The same table from one mergeable sketch: nearest ranks instead of interpolation, error 1/accuracy."""
    kept = with_keys(df, groups).where(present(col_q(value).cast("double")))
    sketch = kept.groupBy(*map(col_q, groups)).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx(col_q(value).cast("double"), list(probs.values()), accuracy).alias("__q")
    )
    return sketch.select(*map(col_q, groups), "n", *[F.col("__q")[i].alias(p) for i, p in enumerate(probs)])
