"""Column names as data: quoting, and predicates over names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Back-quote a name, so that dots, slashes and spaces in it are literal."""
    return "`" + name.replace("`", "``") + "`"


def col_q(name: str) -> Column:
    return F.col(quoted(name))


def names_starting_with(names: Iterable[str], prefixes: Iterable[str]) -> list[str]:
    return [n for n in names if n.startswith(tuple(prefixes))]


def names_containing(names: Iterable[str], markers: Iterable[str]) -> list[str]:
    wanted = list(markers)
    return [n for n in names if any(m in n for m in wanted)]
