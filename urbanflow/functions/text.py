"""Text normalisation and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed at both ends: all Unicode white space, not only the blank that TRIM removes.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The texts that count as a flag.
YES_NO = {"yes": True, "no": False}
FLAG_TEXTS = {"true": 1, "false": 0, "yes": 1, "no": 0, "1": 1, "0": 0}
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def trim_lower_map(c: Column, mapping: dict[str, object]) -> Column:
    """Stripped, lower-cased text looked up in `mapping`; NULL for any other text."""
    text = F.lower(strip(c.cast("string")))
    items = list(mapping.items())
    out = F.when(text == items[0][0], F.lit(items[0][1]))
    for key, value in items[1:]:
        out = out.when(text == key, F.lit(value))
    return out


def boolean_to_int(c: Column) -> Column:
    """Flag as TINYINT: the flag texts, else a number cut to its integer part; NULL when it is neither."""
    text = strip(c.cast("string"))
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.coalesce(trim_lower_map(c, FLAG_TEXTS).cast("double"), number).try_cast("tinyint")


def boolean_to_int_strict(c: Column) -> Column:
    """As `boolean_to_int`, but a value that is no flag (or is missing) is an error."""
    text = F.coalesce(c.cast("string"), F.lit("NULL"))
    return F.coalesce(
        boolean_to_int(c), F.raise_error(F.concat(F.lit("unexpected flag value: "), text)).cast("tinyint")
    )


def join_text(separator: str, *parts: Column) -> Column:
    """Join the parts that are present."""
    return F.concat_ws(separator, *parts)
