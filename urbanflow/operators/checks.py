"""Run-time guards on schema and values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflow.functions.dates import to_date_lenient
from urbanflow.functions.names import col_q

# An error message shows this many offending values and says how many there are in all.
SHOWN = 1000


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Project to exactly `required`, in that order; a missing column is an error that names all missing ones."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select([col_q(c) for c in required])


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]


def check_numeric(df: DataFrame) -> DataFrame:
    """The input, or an error that names every column that is not a number (flags and texts are not)."""
    bad = non_numeric_columns(df)
    if bad:
        raise ValueError(f"non-numeric columns: {bad}")
    return df


def offending_values(df: DataFrame, column: str, mapped: Column) -> DataFrame:
    """Distinct values of `column` for which `mapped` is NULL, with their row counts."""
    return df.where(mapped.isNull()).groupBy(col_q(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def check_values(df: DataFrame, column: str, mapped: Column) -> DataFrame:
    """The input, or an error listing values of `column` that `mapped` does not know; `offending_values` has them all.

    Runs one job, and another to count them when there are more than the message shows.
    """
    bad = offending_values(df, column, mapped)
    shown = bad.orderBy(F.col("value").asc_nulls_first()).limit(SHOWN + 1).collect()
    if shown:
        more = f" and others, {bad.count()} in all" if len(shown) > SHOWN else ""
        raise ValueError(f"unexpected values in {column}: {[r['value'] for r in shown[:SHOWN]]}{more}")
    return df


def check_dates(df: DataFrame, column: str, fmt: str | None = None) -> DataFrame:
    """The input, or an error when a date is missing or cannot be parsed."""
    return check_values(df, column, to_date_lenient(col_q(column), fmt))


class Watch:
    """Checks of values that ride along with the job that reads a table anyway.

    `table` is the input with a named count per check of the rows whose value does not map. When a job has read it,
    `verify` raises one error that lists the values of every failed check; only then is the table read again.
    """

    def __init__(self, df: DataFrame, mapped: dict[str, Column]) -> None:
        self.source, self.mapped, self.seen = df, mapped, Observation()
        counts = [F.count_if(m.isNull()).alias(f"bad{i}") for i, m in enumerate(mapped.values())]
        self.table = df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *counts) if mapped else df

    def counts(self) -> dict[str, int]:
        """Offending rows per column, exact, once a job has read the table."""
        found = self.seen.get if self.mapped else {}
        return {c: found[f"bad{i}"] for i, c in enumerate(self.mapped)}

    def verify(self) -> None:
        failed = {c: n for c, n in self.counts().items() if n}
        told = []
        for column, rows in failed.items():
            bad = offending_values(self.source, column, self.mapped[column])
            shown = bad.orderBy(F.col("value").asc_nulls_first()).limit(SHOWN + 1).collect()
            more = f" and others, {bad.count()} in all" if len(shown) > SHOWN else ""
            told.append(f"{column}: {[r['value'] for r in shown[:SHOWN]]}{more} in {rows} rows")
        if told:
            raise ValueError("unexpected values in " + "; ".join(told))
