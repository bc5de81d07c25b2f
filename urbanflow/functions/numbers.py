"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_n(c: Column, digits: int) -> Column:
    """Rounded value without a negative zero."""
    return F.round(c, digits) + F.lit(0.0)


def scale(c: Column, factor: float) -> Column:
    return c * F.lit(factor)


def mean_of_two(a: Column, b: Column) -> Column:
    return (a + b) / F.lit(2.0)


def fill_missing(c: Column, *others: Column) -> Column:
    return F.coalesce(c, *others)


def present(c: Column) -> Column:
    """True where a number is neither NULL nor NaN."""
    return c.isNotNull() & ~F.isnan(c)
