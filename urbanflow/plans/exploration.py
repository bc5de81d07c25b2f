"""The tables behind the charts, clustering of standardised measurements, and advisories per area and road."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow import schema as S
from urbanflow.functions.names import col_q
from urbanflow.functions.numbers import present
from urbanflow.operators.aggregates import (
    group_sum_labelled,
    level_values,
    mixed_profile,
    pivot_sum,
    ratio_to_max,
    share_of_total,
)
from urbanflow.operators.bins import box_stats, hexbin_density, histogram
from urbanflow.operators.cluster import kmeans_assign, kmeans_fit
from urbanflow.operators.reduce import pca_scores, standardize
from urbanflow.operators.projection import select_excluding_substring
from urbanflow.operators.rules import ADVISORY_RULES, Ladder, advisory_rules
from urbanflow.operators.statistics import corr_matrix, describe_columns, target_correlation
from urbanflow.sources.tables import scan_pruned

SCALED = "__z"
SCORES = ["pc1", "pc2"]


def weather_correlations(spark: SparkSession, path: str, schema=None, fmt: str | None = None) -> DataFrame:
    """Correlations of the nineteen weather columns to three digits; only those columns are read."""
    return corr_matrix(scan_pruned(spark, path, S.WEATHER_CORRELATES, schema, fmt), S.WEATHER_CORRELATES, digits=3)


def encoded_tables(encoded: DataFrame) -> dict[str, DataFrame]:
    """Summary and correlations of the encoded table; one-hot columns are left out of the matrix only."""
    return {
        "summary": describe_columns(encoded),
        "core_correlations": corr_matrix(select_excluding_substring(encoded, S.CATEGORY_PREFIXES)),
        "volume_correlations": target_correlation(encoded, S.VOLUME),
    }


def chart_tables(df: DataFrame) -> dict[str, DataFrame]:
    """One small table per chart of the enriched rows. Each is lazy; only the categories and box sizes are computed here."""
    levels = level_values(df, [S.AREA, S.ROAD])
    return {
        "area_by_road": pivot_sum(df, S.AREA, S.ROAD, S.VOLUME, levels[S.ROAD]),
        "area_road_totals": group_sum_labelled(df, S.AREA, S.ROAD, S.VOLUME),
        "travel_time_boxes": box_stats(df, [S.AREA], "Travel Time Index"),
        "incident_shares": share_of_total(df, S.AREA, "Incident Reports"),
        "capacity_histogram": histogram(df, "Road Capacity Utilization"),
        "congestion_by_area": ratio_to_max(df, S.AREA, "Congestion Level"),
        "speed_volume_density": hexbin_density(df, "Average Speed", S.VOLUME),
        "weather_by_area": pivot_sum(df, S.WEATHER, S.AREA, S.VOLUME, levels[S.AREA], fill=0),
    }


def score_table(df: DataFrame, columns: list[str] = S.MEASURES) -> DataFrame:
    """The rows with their scores on the first two principal axes of the standardised columns.

    A row that misses one of the columns (NULL or NaN) has no place on the axes and is left out.
    """
    complete = df.where(F.forall(F.array(*[present(col_q(c).cast("double")) for c in columns]), lambda known: known))
    scaled = standardize(complete, columns, SCALED)
    return pca_scores(scaled, [c + SCALED for c in columns]).drop(*[c + SCALED for c in columns])


@dataclass(frozen=True)
class Clusters:
    rows: DataFrame
    model: KMeansModel


def cluster_rows(df: DataFrame, columns: list[str] = S.MEASURES, k: int = 2) -> Clusters:
    """Rows with their cluster. The input is read several times: pass a table, or `materialize` a derived one."""
    scored = score_table(df, columns)
    model = kmeans_fit(scored, SCORES, k)
    return Clusters(kmeans_assign(scored, SCORES, model), model)


def area_road_profile(df: DataFrame) -> DataFrame:
    """Means of ten measurements, the sum of incidents and two modes per (area, road)."""
    means = [c for c in S.MEASURES if c != "Incident Reports"]
    return mixed_profile(df, [S.AREA, S.ROAD], means, ["Incident Reports"], [S.WEATHER, S.ROADWORK])


def area_road_advisories(df: DataFrame, rules: tuple[Ladder, ...] = ADVISORY_RULES) -> DataFrame:
    return advisory_rules(area_road_profile(df), rules)
