"""Column selection, renaming, filters and the year split."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow import schema as S
from urbanflow.functions.dates import to_date_strict
from urbanflow.functions.names import col_q, names_containing, names_starting_with


def keep(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select([col_q(n) for n in names])


def ordered_names(
    names: list[str],
    direct: list[str] = S.DIRECT_FEATURES,
    derived: list[str] = S.CYCLE_FEATURES,
    prefixes: list[str] = S.CATEGORY_PREFIXES,
) -> list[str]:
    """Names in allow-list order: direct, derived, then each prefix group in input order."""
    present = [n for n in [*direct, *derived] if n in names]
    return present + [n for p in prefixes for n in names_starting_with(names, [p])]


def select_allowlist_ordered(df: DataFrame, **lists: list[str]) -> DataFrame:
    """Keep allow-listed columns in list order, skipping absent ones; nothing left is an error."""
    names = ordered_names(df.columns, **lists)
    if not names:
        raise ValueError("none of the wanted columns is present")
    return keep(df, names)


def stable_names(
    names: list[str],
    direct: list[str] = S.DIRECT_FEATURES,
    derived: list[str] = [*S.CYCLE_FEATURES, S.IS_HOLIDAY],  # noqa: B006
    prefixes: list[str] = S.CATEGORY_PREFIXES,
) -> tuple[list[str], list[str]]:
    """Allow-listed or prefixed names in input order, and the sorted direct names that are absent."""
    wanted = {*direct, *derived, *names_starting_with(names, prefixes)}
    return [n for n in names if n in wanted], sorted(set(direct) - set(names))


def select_allowlist_stable(df: DataFrame, **lists: list[str]) -> tuple[DataFrame, list[str]]:
    """Keep allow-listed columns in input order; also return the direct columns that are missing."""
    names, missing = stable_names(df.columns, **lists)
    return keep(df, names), missing


def select_excluding_substring(df: DataFrame, markers: list[str]) -> DataFrame:
    """Drop every column whose name contains a marker anywhere."""
    dropped = set(names_containing(df.columns, markers))
    return keep(df, [n for n in df.columns if n not in dropped])


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns; unlike `DataFrame.drop`, an unknown name is an error."""
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"columns to drop are not present: {unknown}")
    return keep(df, [n for n in df.columns if n not in names])


def feature_names(df: DataFrame, target: str, exclude: list[str] = ()) -> list[str]:
    """All columns but the label and the excluded ones (date, key)."""
    return [n for n in df.columns if n != target and n not in exclude]


def feature_target_split(df: DataFrame, target: str, exclude: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """X (all but the label and the excluded columns) and y (the label)."""
    return keep(df, feature_names(df, target, list(exclude))), keep(df, [target])


def filter_before_cutoff(df: DataFrame, column: str, cutoff: str) -> DataFrame:
    """Rows strictly before the cutoff. Missing dates are dropped, unreadable ones are an error.

    Dates and timestamps are compared as they are, so that the predicate reaches the file reader.
    """
    kind = dict(df.dtypes)[column]
    value = to_date_strict(col_q(column)) if kind == "string" else col_q(column)
    return df.where(value < F.lit(date.fromisoformat(cutoff)))


def in_year(column: str, year: int) -> Column:
    """Half-open range instead of year(d) = y: the range is pushed to the reader and prunes partitions."""
    return (col_q(column) >= F.lit(date(year, 1, 1))) & (col_q(column) < F.lit(date(year + 1, 1, 1)))


def split_by_year(
    df: DataFrame, column: str, years: dict[str, int] = S.SPLIT_YEARS, out: str = "split"
) -> DataFrame:
    """Label rows with the split of their year; other years and missing dates fall out."""
    label = F.lit(None).cast("string")
    span = F.lit(False)
    for name, year in years.items():
        label = F.when(in_year(column, year), F.lit(name)).otherwise(label)
        span = span | in_year(column, year)
    return df.where(span).withColumn(out, label)
