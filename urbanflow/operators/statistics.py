"""Column summaries and Pearson correlations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflow.functions.names import col_q
from urbanflow.functions.numbers import present
from urbanflow.operators.quantiles import approx_quantiles, exact_quantiles
from urbanflow.session import join_lookup, materialize

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def long_form(df: DataFrame, columns: list[str], kind: str, keep: list[str] = ()) -> DataFrame:
    """One (position, value) row per cell; the position of the column in `columns` is a cheaper key than its name."""
    cells = [c for i, name in enumerate(columns) for c in (F.lit(i), col_q(name).cast(kind))]
    return df.select(*map(col_q, keep), F.stack(F.lit(len(columns)), *cells).alias("position", "value"))


def column_name(columns: list[str]) -> Column:
    """The name for a `position` of `long_form`."""
    return F.element_at(F.array(*map(F.lit, columns)), F.col("position") + 1)


def describe_columns(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """One row per column: count, mean, std, min, quartiles, max of numbers; count, unique, top, freq of others.

    Fields that apply to none of the columns are left out. Quartiles interpolate linearly, std is the sample deviation. The top value is the smallest on a tie.
    """
    columns = columns or df.columns
    numbers = [c for c in numeric_columns(df) if c in columns]
    others = [c for c in columns if c not in numbers]
    parts = []
    if numbers:
        cells = long_form(df, numbers, "double").where(present(F.col("value")))
        moments = materialize(cells.groupBy("position").agg(
            F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"), F.max("value").alias("max"),
        ))
        if approx:
            quartiles = approx_quantiles(cells, ["position"], "value", QUARTILES)
        else:
            quartiles = exact_quantiles(cells, ["position"], "value", QUARTILES, sizes=moments.select("position", "n"))
        table = _positions(df, numbers).join(moments, "position", "left").join(quartiles.drop("n"), "position", "left")
        parts.append(table.withColumn("column", column_name(numbers)))
    if others:
        table = _positions(df, others).join(_text_summary(long_form(df, others, "string")), "position", "left")
        parts.append(table.withColumn("column", column_name(others)))
    if len(parts) == 1:
        table = parts[0]
    else:
        table = parts[0].unionByName(parts[1], allowMissingColumns=True)
    order = ["unique", "top", "freq", "mean", "std", "min", *QUARTILES, "max"]
    fields = [F.col(c) for c in order if c in table.columns]
    return table.select("column", F.coalesce("n", F.lit(0)).alias("count"), *fields).orderBy("column")


def _text_summary(cells: DataFrame) -> DataFrame:
    """(position, n, unique, top, freq) of (position, value): texts are counted by their hashes of 256 bits.

    Only values that are as frequent as the most frequent one are fetched; where every value occurs once, the smallest
    one needs no counting at all. So no text is a shuffle key.
    """
    cells = cells.where("value IS NOT NULL").withColumn("h", F.unhex(F.sha2("value", 256)))
    counts = materialize(cells.groupBy("position", "h").agg(F.count(F.lit(1)).alias("freq")))
    summary = materialize(counts.groupBy("position").agg(F.sum("freq").alias("n"), F.count(F.lit(1)).alias("unique"), F.max("freq").alias("freq")))
    once = [r["position"] for r in summary.where("freq = 1").collect()]
    repeated = counts.join(F.broadcast(summary.where("freq > 1").select("position", "freq")), ["position", "freq"]).select("position", "h")
    winners = join_lookup(cells.where(~F.col("position").isin(once)), repeated, ["position", "h"], "left_semi").select("position", "value")
    top = cells.where(F.col("position").isin(once)).select("position", "value").unionByName(winners)
    return summary.join(top.groupBy("position").agg(F.min("value").alias("top")), "position")


def _positions(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("position"))


def _clamped(r: Column) -> Column:
    """Within [-1, 1]; a missing or undefined r is missing (least and greatest skip NULLs)."""
    r = F.nanvl(r, F.lit(None).cast("double"))
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def _clean(c: str) -> Column:
    return F.nanvl(col_q(c).cast("double"), F.lit(None).cast("double"))


_MOMENTS = "pair int, n long, mx double, my double, cxx double, cyy double, cxy double, endless long"


def pair_moments(df: DataFrame, columns: list[str], pairs: list[tuple[int, int]]) -> DataFrame:
    """(pair, n, means, centred sums, endless) of the rows that have both columns of a pair, a row per task and pair.

    A task keeps one buffer, into which the moments of whole batches are merged. Pairs whose columns are present in the
    same rows share a product of matrices that is centred on just those rows, so nothing cancels. `endless` counts
    infinite values, which enter no sum.
    """
    x, y = (np.array([p[k] for p in pairs]) for k in (0, 1))

    def of_batch(values: np.ndarray) -> np.ndarray:
        """(n, mx, my, cxx, cyy, cxy, endless) by pair."""
        out = np.zeros((7, len(x)))
        there, endless = ~np.isnan(values), np.isinf(values)
        finite = there & ~endless
        _, kind = np.unique(np.packbits(finite, axis=0), axis=1, return_inverse=True)
        kind = kind.ravel()
        blocks = kind[x] * (int(kind.max()) + 1) + kind[y]
        for block in np.unique(blocks):
            mine = np.flatnonzero(blocks == block)
            rows = finite[:, x[mine[0]]] & finite[:, y[mine[0]]]
            n = int(rows.sum())
            if n:
                used, place = np.unique(np.concatenate([x[mine], y[mine]]), return_inverse=True)
                own = values[rows][:, used]
                z = own - own[0]  # a constant gives zeros exactly
                middle = z.mean(axis=0)
                product = (z - middle).T @ (z - middle)
                i, j = place[: len(mine)], place[len(mine) :]
                mean = own[0] + middle
                out[:6, mine] = np.full(len(mine), n), mean[i], mean[j], product[i, i], product[j, j], product[i, j]
        if endless.any():
            met = endless.T.astype(float) @ there.astype(float)
            out[6] = met[x, y] + met[y, x]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = np.zeros((7, len(x)))
        for batch in batches:
            if not batch.num_rows:
                continue
            b = of_batch(np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]))
            n = np.maximum(a[0] + b[0], 1)
            dx, dy = np.where(a[0] > 0, b[1] - a[1], 0) * (b[0] > 0), np.where(a[0] > 0, b[2] - a[2], 0) * (b[0] > 0)
            both = a[0] * b[0] / n
            means = [np.where(a[0] > 0, a[k] + d * b[0] / n, b[k]) for k, d in ((1, dx), (2, dy))]
            a = np.stack([a[0] + b[0], *means, a[3] + b[3] + dx * dx * both, a[4] + b[4] + dy * dy * both, a[5] + b[5] + dx * dy * both, a[6] + b[6]])
        kinds = [pa.int32(), pa.int64(), *[pa.float64()] * 5, pa.int64()]
        found = [np.arange(len(x)), a[0].astype(np.int64), *a[1:6], a[6].astype(np.int64)]
        rows = pa.RecordBatch.from_arrays([pa.array(f, k) for f, k in zip(found, kinds)], [k.split()[0] for k in _MOMENTS.split(", ")])
        yield rows.filter(pa.array((a[0] > 0) | (a[6] > 0)))

    return df.select([_clean(c).alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(run, _MOMENTS)


def pair_correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(x, y, r) for the listed pairs from one scan; missing values are deleted pairwise.

    Tasks reduce their rows to moments per pair, which merge by the rule for parallel variances. A pair of which one side
    is constant, empty or infinite has no r.
    """
    spark = df.sparkSession
    if not pairs:
        return spark.createDataFrame([], "x string, y string, r double")
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    place = {c: i for i, c in enumerate(columns)}
    parts = materialize(pair_moments(df, columns, [(place[x], place[y]) for x, y in pairs]))
    means = parts.groupBy("pair").agg((F.sum(F.col("n") * F.col("mx")) / F.sum("n")).alias("ax"), (F.sum(F.col("n") * F.col("my")) / F.sum("n")).alias("ay"))
    dx, dy = F.col("mx") - F.col("ax"), F.col("my") - F.col("ay")
    merged = parts.join(means, "pair").groupBy("pair").agg(
        F.sum(F.col("cxx") + F.col("n") * dx * dx).alias("sxx"), F.sum(F.col("cyy") + F.col("n") * dy * dy).alias("syy"),
        F.sum(F.col("cxy") + F.col("n") * dx * dy).alias("sxy"), F.sum("endless").alias("endless"),
        ((F.max("cxx") > 0) | (F.max("mx") > F.min("mx"))).alias("x_varies"), ((F.max("cyy") > 0) | (F.max("my") > F.min("my"))).alias("y_varies"),
    )
    known = F.col("x_varies") & F.col("y_varies") & (F.col("endless") == 0)
    total = merged.select("pair", F.when(known, _clamped(F.try_divide(F.col("sxy"), F.sqrt("sxx") * F.sqrt("syy")))).alias("r"))
    named = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pairs)], "pair int, x string, y string")
    itself = F.when((F.col("x") == F.col("y")) & F.col("r").isNotNull(), F.lit(1.0)).otherwise(F.col("r"))
    return named.join(total, "pair", "left").select("x", "y", itself.alias("r"))


def corr_matrix(df: DataFrame, columns: list[str] | None = None, digits: int | None = None) -> DataFrame:
    """Symmetric Pearson matrix in long form (x, y, r), diagonal included; only half of it is computed."""
    columns = columns or numeric_columns(df)
    half = pair_correlations(df, [(a, b) for i, a in enumerate(columns) for b in columns[i:]])
    cell = F.struct("x", "y", "r")
    mirrored = F.when(F.col("x") != F.col("y"), F.array(cell, F.struct(F.col("y").alias("x"), F.col("x").alias("y"), "r")))
    full = half.select(F.explode(F.coalesce(mirrored, F.array(cell))).alias("p")).select("p.*")
    return full if digits is None else full.select("x", "y", (F.round("r", digits) + F.lit(0.0)).alias("r"))


def target_correlation(df: DataFrame, target: str, features: list[str] | None = None) -> DataFrame:
    """(feature, r) of every other numeric column with the target, highest first, undefined ones last."""
    features = [c for c in (features or numeric_columns(df)) if c != target]
    found = pair_correlations(df, [(f, target) for f in features])
    return found.select(F.col("x").alias("feature"), "r").orderBy(F.col("r").desc_nulls_last(), "feature")
