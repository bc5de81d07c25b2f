"""Advisories from rule ladders given as a table."""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq, gt, lt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflow.functions.names import col_q

_TESTS = {">": gt, "<": lt, "=": eq}


@dataclass(frozen=True)
class Step:
    """One rung: every (operator, constant) must hold for the text to apply."""

    when: tuple[tuple[str, object], ...]
    text: str


@dataclass(frozen=True)
class Ladder:
    """Rungs on one column, tried in order; `otherwise` applies when none does (None: no text at all)."""

    column: str
    steps: tuple[Step, ...]
    otherwise: str | None = None


# Thresholds are fixed values. A congestion of exactly 75 is neither above nor below it and ends in `otherwise`.
ADVISORY_RULES = (
    Ladder("Congestion Level", (
        Step(((">", 75),), "Congestion high: avoid at peak hours"),
        Step(((">", 50), ("<", 75)), "Congestion moderate: allow extra time"),
    ), "Congestion low: free flow"),
    Ladder("Incident Reports", (
        Step(((">", 10),), "Incidents frequent: delays are likely"),
        Step(((">", 5),), "Incidents occasional: short delays possible"),
    ), "Incidents rare"),
    Ladder("Environmental Impact", (
        Step(((">", 150),), "Emissions high: travel less if possible"),
        Step(((">", 100),), "Emissions moderate: watch air quality"),
    ), "Emissions low"),
    Ladder("Average Speed", (
        Step((("<", 20),), "Speed low: slow traffic"),
        Step((("<", 40),), "Speed moderate"),
    ), "Speed high"),
    Ladder("Travel Time Index", (Step(((">", 1.3),), "Trips take longer than usual"),), "Trips take the usual time"),
    Ladder("Weather Conditions", (
        Step((("=", "Rain"),), "Wet roads: drive with care"),
        Step((("=", "Fog"),), "Poor sight: keep a distance"),
        Step((("=", "Clear"),), "Weather clear"),
    )),
)


def ladder_text(df: DataFrame, ladder: Ladder) -> Column:
    """The text of the first rung that holds. NaN counts as missing, and a missing value meets no rung."""
    value = col_q(ladder.column)
    if isinstance(df.schema[ladder.column].dataType, (T.DoubleType, T.FloatType)):
        value = F.nanvl(value, F.lit(None))
    chain = None
    for step in ladder.steps:
        holds = F.lit(True)
        for sign, constant in step.when:
            holds = holds & _TESTS[sign](value, F.lit(constant))
        chain = F.when(holds, step.text) if chain is None else chain.when(holds, step.text)
    return chain.otherwise(F.lit(ladder.otherwise)) if ladder.otherwise is not None else chain


def advisory_rules(
    df: DataFrame, rules: tuple[Ladder, ...] = ADVISORY_RULES, out: str = "Overall Advisory", separator: str = " | "
) -> DataFrame:
    """Add one text per row: the texts of all ladders, joined."""
    return df.withColumn(out, F.concat_ws(separator, *[ladder_text(df, ladder) for ladder in rules]))
