"""Standardisation and principal components as column expressions."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.functions.names import col_q


def vector_of(columns: list[str]) -> Column:
    """Columns as one vector; a missing value is an error. Works for names with dots and slashes."""
    cells = []
    for c in columns:
        failure = F.raise_error(F.lit(f"missing value in feature {c}")).cast("double")
        value = F.nanvl(col_q(c).cast("double"), F.lit(None).cast("double"))
        cells.append(F.coalesce(value, failure))
    return array_to_vector(F.array(*cells))


def standardize(df: DataFrame, columns: list[str], suffix: str = "") -> DataFrame:
    """(x - mean) / population deviation per column; a constant column becomes 0, a missing value (NULL, NaN) NULL.

    Means and deviations are one row of aggregates (a scalar subquery), so the data is not shuffled. With a suffix
    the originals stay and the new columns are appended.
    """
    values = [F.nanvl(col_q(c).cast("double"), F.lit(None).cast("double")) for c in columns]
    moments = []
    for i, v in enumerate(values):
        moments += [F.avg(v).alias(f"m{i}"), F.stddev_pop(v).alias(f"s{i}")]
    stats = df.agg(F.struct(*moments).alias("s")).scalar()
    scaled = {}
    for i, (c, v) in enumerate(zip(columns, values)):
        spread = F.when(stats[f"s{i}"] == 0, F.lit(1.0)).otherwise(stats[f"s{i}"])
        scaled[c] = ((v - stats[f"m{i}"]) / spread).alias(c + suffix)
    if suffix:
        return df.select("*", *scaled.values())
    return df.select([scaled.get(c, col_q(c)) for c in df.columns])


def pca_loadings(df: DataFrame, columns: list[str], k: int = 2) -> np.ndarray:
    """Principal axes as a (columns x k) matrix; each axis is signed so that its largest loading is positive."""
    vectors = df.select(vector_of(columns).alias("v"))
    axes = PCA(k=k, inputCol="v", outputCol="p").fit(vectors).pc.toArray()
    largest = axes[np.abs(axes).argmax(axis=0), np.arange(k)]
    return axes * np.where(largest < 0, -1.0, 1.0)


def pca_scores(df: DataFrame, columns: list[str], k: int = 2, prefix: str = "pc") -> DataFrame:
    """Append the scores on the first `k` axes of columns that are already centred (see `standardize`)."""
    axes = pca_loadings(df, columns, k)
    scores = []
    for j in range(k):
        terms = [col_q(c) * F.lit(float(axes[i, j])) for i, c in enumerate(columns)]
        total = terms[0]
        for term in terms[1:]:
            total = total + term
        scores.append(total.alias(f"{prefix}{j + 1}"))
    return df.select("*", *scores)
