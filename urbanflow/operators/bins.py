"""Histograms, hexagonal densities and box statistics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.functions.names import col_q
from urbanflow.functions.numbers import present
from urbanflow.operators.aggregates import with_keys
from urbanflow.operators.quantiles import exact_quantiles
from urbanflow.operators.statistics import column_name, long_form
from urbanflow.session import join_lookup, materialize

# Fixed value: a box whisker reaches at most this many interquartile ranges.
WHISKER = 1.5


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """(bin, left_edge, right_edge, rows) for equal-width bins between the least and the largest value.

    The last bin is closed on the right; empty bins are present; missing values are ignored. When all values are
    equal the range is widened by one half on both sides. The range is a scalar subquery over the same column.
    """
    data = df.select(col_q(value).cast("double").alias("v")).where(present(F.col("v")))
    low, high = F.min("v"), F.max("v")
    pad = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    span = data.agg(F.struct((low - pad).alias("lo"), (high + pad).alias("hi")).alias("s"))
    lo, hi = span.scalar()["lo"], span.scalar()["hi"]
    width = (hi - lo) / F.lit(float(bins))

    def edge(i: Column) -> Column:
        return F.when(i == bins, hi).otherwise(lo + i * width)

    v = F.col("v")
    guess = F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1))
    # The division may land one bin off next to an edge; the edges themselves decide.
    settled = (
        F.when(v < edge(guess), guess - 1)
        .when((v >= edge(guess + 1)) & (guess != bins - 1), guess + 1)
        .otherwise(guess)
    )
    counts = data.select(settled.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))
    frame = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    full = frame.join(counts, "bin", "left")
    b = F.col("bin")
    return full.select(
        "bin", edge(b).alias("left_edge"), edge(b + 1).alias("right_edge"), F.coalesce("rows", F.lit(0)).alias("rows")
    ).orderBy("bin")


def _open_range(low: Column, high: Column) -> tuple[Column, Column]:
    """Widen a range of one value by a tenth of it (by 0.1 around zero), so that it has a width."""
    flat = (high - low) <= F.greatest(F.abs(low), F.abs(high)) * F.lit(1e-15)
    pad = F.when(~flat, F.lit(0.0)).when((low == 0) & (high == 0), F.lit(0.1))
    return low - F.coalesce(pad, F.lit(0.1) * F.abs(low)), high + F.coalesce(pad, F.lit(0.1) * F.abs(high))


def hexbin_density(df: DataFrame, x: str, y: str, gridsize: int = 30, mincnt: int = 1) -> DataFrame:
    """(lattice, ix, iy, x_center, y_center, rows) for hexagonal cells that hold at least `mincnt` rows.

    Two interleaved rectangular lattices (the second shifted by half a cell) cover the plane; a point belongs to the
    nearer centre, to the second lattice on a tie. Rows that miss a coordinate are ignored.
    """
    data = df.select(col_q(x).cast("double").alias("x"), col_q(y).cast("double").alias("y"))
    data = data.where(present(F.col("x")) & present(F.col("y")))
    nx, ny = gridsize, int(gridsize / math.sqrt(3))
    x_lo, x_hi = _open_range(F.min("x"), F.max("x"))
    y_lo, y_hi = _open_range(F.min("y"), F.max("y"))
    padding = F.lit(1e-9) * (x_hi - x_lo)
    origin = data.agg(
        F.struct(
            (x_lo - padding).alias("x0"),
            (((x_hi + padding) - (x_lo - padding)) / F.lit(float(nx))).alias("sx"),
            y_lo.alias("y0"),
            ((y_hi - y_lo) / F.lit(float(ny))).alias("sy"),
        ).alias("s")
    )
    x0, sx, y0, sy = (origin.scalar()[f] for f in ("x0", "sx", "y0", "sy"))
    placed = data.select(((F.col("x") - x0) / sx).alias("u"), ((F.col("y") - y0) / sy).alias("w"))
    u, w = F.col("u"), F.col("w")

    def distance(cu: Column, cw: Column) -> Column:
        return (u - cu) * (u - cu) + F.lit(3.0) * (w - cw) * (w - cw)

    half = F.lit(0.5)
    first = distance(F.rint(u), F.rint(w)) < distance(F.floor(u) + half, F.floor(w) + half)
    cells = placed.select(
        F.when(first, 1).otherwise(2).alias("lattice"),
        F.when(first, F.rint(u)).otherwise(F.floor(u)).cast("long").alias("ix"),
        F.when(first, F.rint(w)).otherwise(F.floor(w)).cast("long").alias("iy"),
    )
    counts = cells.groupBy("lattice", "ix", "iy").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= mincnt)
    shift = F.when(F.col("lattice") == 2, half).otherwise(F.lit(0.0))
    return counts.select(
        "lattice", "ix", "iy",
        (x0 + (F.col("ix") + shift) * sx).alias("x_center"),
        (y0 + (F.col("iy") + shift) * sy).alias("y_center"),
        "rows",
    )


BOX_QUANTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _fences() -> tuple[Column, Column]:
    reach = F.lit(WHISKER) * (F.col("q3") - F.col("q1"))
    return F.col("q1") - reach, F.col("q3") + reach


def box_stats(df: DataFrame, groups: list[str], value: str, **options: int) -> DataFrame:
    """Per group: n, quartiles, whiskers (the furthest values inside the fences) and the number of outliers.

    Keys and values are written once; ordering, bracketing and the fences read that table, so the input is computed once.
    """
    values = with_keys(df, groups).select(*map(col_q, groups), col_q(value).cast("double").alias("__v"))
    cells = materialize(values.where(present(F.col("__v"))))
    quartiles = exact_quantiles(cells, groups, "__v", BOX_QUANTILES, **options)
    joined = _with_quartiles(cells, groups, "__v", quartiles)
    low, high = _fences()
    v = F.col("__v")
    spans = joined.groupBy(*map(col_q, groups), "n", "q1", "median", "q3").agg(
        F.min(F.when(v >= low, v)).alias("lowest"),
        F.max(F.when(v <= high, v)).alias("highest"),
        F.sum(((v < low) | (v > high)).cast("long")).alias("outliers"),
    )
    return spans.select(
        *map(col_q, groups), "n",
        F.least("q1", "lowest").alias("whisker_lo"), "q1", "median", "q3",
        F.greatest("q3", "highest").alias("whisker_hi"), "outliers",
    ).orderBy(*map(col_q, groups))


def _with_quartiles(df: DataFrame, groups: list[str], value: str, quartiles: DataFrame) -> DataFrame:
    data = with_keys(df, groups).withColumn("__v", col_q(value).cast("double")).where(present(F.col("__v")))
    return join_lookup(data, quartiles, groups, "inner")


def box_outliers(df: DataFrame, groups: list[str], value: str, **options: int) -> DataFrame:
    """The rows outside the fences of their group, with all their columns."""
    quartiles = exact_quantiles(df, groups, value, BOX_QUANTILES, **options)
    low, high = _fences()
    joined = _with_quartiles(df, groups, value, quartiles)
    return joined.where((F.col("__v") < low) | (F.col("__v") > high)).select([col_q(c) for c in df.columns])


def box_stats_unpivot(df: DataFrame, group: str, values: list[str], **options: int) -> DataFrame:
    """Box statistics of many columns by one group, as one job over (column, value) cells."""
    stats = box_stats(long_form(df, values, "double", [group]), [group, "position"], "value", **options)
    rest = [c for c in stats.columns if c not in (group, "position")]
    return stats.select(col_q(group), column_name(values).alias("column"), *rest).orderBy(col_q(group), "column")
