"""Grouped aggregates. Groups with a missing key are left out; a sum over nothing is 0.

Every aggregate is computed in two stages, so that a hot group sends one partial row per task and value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanflow.functions.names import col_q, quoted



def with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    for key in keys:
        df = df.where(col_q(key).isNotNull())
    return df


def sum_or_zero(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"))


def year_counts(df: DataFrame, column: str) -> DataFrame:
    years = df.where(col_q(column).isNotNull()).groupBy(F.year(col_q(column)).alias("year"))
    return years.agg(F.count(F.lit(1)).alias("rows")).orderBy("year")


def group_sum(df: DataFrame, keys: list[str], value: str, out: str = "total") -> DataFrame:
    grouped = with_keys(df, keys).groupBy(*map(col_q, keys))
    return grouped.agg(sum_or_zero(col_q(value)).alias(out)).orderBy(*map(col_q, keys))


def group_sum_labelled(df: DataFrame, first: str, second: str, value: str, out: str = "total") -> DataFrame:
    """Sum by two keys, with the label `first - second`."""
    sums = group_sum(df, [first, second], value, out)
    return sums.withColumn("label", F.concat_ws(" - ", col_q(first), col_q(second)))


def group_mean(df: DataFrame, keys: list[str], value: str, out: str = "mean") -> DataFrame:
    return with_keys(df, keys).groupBy(*map(col_q, keys)).agg(F.avg(col_q(value)).alias(out)).orderBy(*map(col_q, keys))


def group_mode(df: DataFrame, keys: list[str], value: str, out: str = "mode") -> DataFrame:
    """Most frequent value per group, the smallest on a tie; missing values do not count, an all-missing group is NULL.

    Values are counted first, so no group is held in memory, however many values it has.
    """
    counts = with_keys(df, keys).groupBy(*map(col_q, keys), col_q(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*map(col_q, keys)).agg(_heaviest("__v", "__n").alias(out))


def _heaviest(value: str, weight: str) -> Column:
    """Value with the largest weight; smallest value on a tie; missing values only when there is no other."""
    rank = F.struct(F.col(value).isNull(), -F.col(weight), F.col(value))
    return F.min_by(F.col(value), rank)


def mixed_profile(
    df: DataFrame, keys: list[str], means: list[str], sums: list[str], modes: list[str]
) -> DataFrame:
    """Means, sums and modes per group from one scan.

    Rows are first reduced to partial sums per (keys, mode values); everything after works on those partial rows.
    Output columns keep the input names.
    """
    m = {c: f"__m{i}" for i, c in enumerate(modes)}
    partial = with_keys(df, keys).groupBy(*map(col_q, keys), *[col_q(c).alias(m[c]) for c in modes])
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(means):
        aggregates += [F.sum(col_q(c).cast("double")).alias(f"__s{i}"), F.count(col_q(c)).alias(f"__c{i}")]
    for i, c in enumerate(sums):
        aggregates.append(F.sum(col_q(c)).alias(f"__t{i}"))
    partial = partial.agg(*aggregates)

    for i, c in enumerate(modes):
        weight = F.sum("__rows").over(W.partitionBy(*map(col_q, keys), F.col(m[c])))
        partial = partial.withColumn(f"__w{i}", weight)
    final = [F.try_divide(F.sum(f"__s{i}"), F.sum(f"__c{i}")).alias(c) for i, c in enumerate(means)]
    final += [sum_or_zero(F.col(f"__t{i}")).alias(c) for i, c in enumerate(sums)]
    final += [_heaviest(m[c], f"__w{i}").alias(c) for i, c in enumerate(modes)]
    return partial.groupBy(*map(col_q, keys)).agg(*final).orderBy(*map(col_q, keys))


def level_values(df: DataFrame, columns: list[str], max_levels: int | None = None) -> dict[str, list]:
    """Sorted distinct values of each column, from one job: they become columns of a plan, so the driver has them.

    More than `max_levels` in a column is an error; there is no limit unless one is given.
    """
    kinds = dict(df.dtypes)
    if len({kinds[c] for c in columns}) > 1:
        return {c: level_values(df, [c], max_levels)[c] for c in columns}
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), col_q(c).alias("v")) for c in columns])).alias("p"))
    rows = pairs.select("p.c", "p.v").where("v IS NOT NULL").distinct().collect()
    levels: dict[str, list] = {c: [] for c in columns}
    for row in rows:
        levels[row["c"]].append(row["v"])
    for c, values in levels.items():
        if max_levels is not None and len(values) > max_levels:
            raise ValueError(f"{c} has too many distinct values ({len(values)}) to become columns: keep it in long form (group_sum)")
    return {c: sorted(values) for c, values in levels.items()}


def pivot_sum(
    df: DataFrame, row: str, column: str, value: str, levels: list | None = None, fill: object = None
) -> DataFrame:
    """Matrix of sums, one column per level of `column`; a combination that does not occur is NULL, or `fill`."""
    if levels is None:
        levels = level_values(df, [column])[column]
    sums = with_keys(df, [row, column]).groupBy(col_q(row), col_q(column)).agg(sum_or_zero(col_q(value)).alias("__t"))
    matrix = sums.groupBy(col_q(row)).pivot(quoted(column), levels).agg(F.max("__t"))
    if fill is not None:
        matrix = matrix.select(
            col_q(row), *[F.coalesce(col_q(c), F.lit(fill)).alias(c) for c in matrix.columns if c != row]
        )
    return matrix.orderBy(col_q(row))


def share_of_total(df: DataFrame, key: str, value: str, digits: int = 1, out: str = "share") -> DataFrame:
    """Sum per group and its percentage of the grand total (a scalar subquery over the sums, not a one-task window)."""
    sums = with_keys(df, [key]).groupBy(col_q(key)).agg(sum_or_zero(col_q(value)).alias("total"))
    total = sums.agg(F.sum("total")).scalar()
    percent = F.try_divide(F.lit(100.0) * F.col("total"), total)
    return sums.select(col_q(key), "total", F.round(percent, digits).alias(out)).orderBy(col_q(key))


def ratio_to_max(df: DataFrame, key: str, value: str, out: str = "ratio") -> DataFrame:
    """Mean per group and its ratio to the largest group mean."""
    means = with_keys(df, [key]).groupBy(col_q(key)).agg(F.avg(col_q(value)).alias("mean"))
    top = means.agg(F.max("mean")).scalar()
    return means.select(col_q(key), "mean", F.try_divide(F.col("mean"), top).alias(out)).orderBy(col_q(key))
