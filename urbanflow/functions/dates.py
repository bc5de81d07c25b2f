"""Calendar expressions. All run inside code generation; none is a Python UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Monday is 0.
DAY_INDEX = {
    "Monday": 0, "Tuesday": 1, "Wednesday": 2, "Thursday": 3, "Friday": 4, "Saturday": 5, "Sunday": 6,
}
SATURDAY, SUNDAY = 5, 6
WEEK_PERIOD = 7.0
YEAR_PERIOD = 365.0


def to_date_lenient(c: Column, fmt: str | None = None) -> Column:
    """Date of a text or timestamp; NULL where it cannot be read."""
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


def to_date_strict(c: Column, fmt: str | None = None) -> Column:
    """Date of a text or timestamp; fails on a value that cannot be read, with ANSI mode on or off."""
    parsed = to_date_lenient(c, fmt)
    failure = F.raise_error(F.concat(F.lit("not a date: "), c.cast("string"))).cast("date")
    return F.when(c.isNotNull() & parsed.isNull(), failure).otherwise(parsed)


def day_name(d: Column) -> Column:
    """Full English day name."""
    return F.date_format(d, "EEEE")


def day_index(name: Column) -> Column:
    """Monday=0 ... Sunday=6 from the full day name; NULL for any other text."""
    out = F.when(name == list(DAY_INDEX)[0], F.lit(0))
    for text, index in list(DAY_INDEX.items())[1:]:
        out = out.when(name == text, F.lit(index))
    return out


def day_index_strict(name: Column) -> Column:
    """As `day_index`, but an unknown or missing name is an error."""
    text = F.coalesce(name, F.lit("NULL"))
    return F.coalesce(day_index(name), F.raise_error(F.concat(F.lit("unknown day name: "), text)).cast("int"))


def weekend_rule(d: Column) -> Column:
    """True on Sundays and on the second and fourth Saturday of a month; false for a missing date."""
    occurrence = F.floor((F.dayofmonth(d) - 1) / 7) + 1
    rule = (F.weekday(d) == SUNDAY) | ((F.weekday(d) == SATURDAY) & occurrence.isin(2, 4))
    return F.coalesce(rule, F.lit(False))


def _clock(c: Column) -> Column:
    """Wall-clock reading as TIMESTAMP_NTZ: a zone suffix never shifts it, and a bare time of day is accepted."""
    text = c.cast("string")
    return F.coalesce(
        text.try_cast("timestamp_ntz"), F.concat(F.lit("1970-01-01 "), F.btrim(text)).try_cast("timestamp_ntz")
    )


def minutes_of_day(c: Column) -> Column:
    """Minutes since midnight with fractions down to the microsecond; NULL where the text is not a time."""
    t = _clock(c)
    return F.hour(t) * 60 + F.minute(t) + F.date_part(F.lit("SECOND"), t).cast("double") / 60


def daylight_minutes(sunrise: Column, sunset: Column) -> Column:
    return minutes_of_day(sunset) - minutes_of_day(sunrise)


def cycle_sin(x: Column, period: float) -> Column:
    return F.sin(x * F.lit(2 * math.pi) / F.lit(period))


def cycle_cos(x: Column, period: float) -> Column:
    return F.cos(x * F.lit(2 * math.pi) / F.lit(period))
