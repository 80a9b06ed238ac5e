"""Small text expressions shared by the other modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space at the ends of a text.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Trim every kind of white space (``trim`` alone only knows the blank)."""
    return F.btrim(value, F.lit(WHITESPACE))


def null_if_empty(value: Column) -> Column:
    return F.when(value != "", value)


def contains_any(value: Column, tokens) -> Column:
    """True when ``value`` holds at least one of the literal ``tokens``."""
    found = F.lit(False)
    for token in tokens:
        found = found | value.contains(token)
    return found


def explode_filled(df, keep, array: Column, name: str):
    """One row per non-NULL element of a costly array expression.

    A plain ``explode`` makes the optimizer test the array for emptiness next to
    the scan, which would compute it twice; the outer form does not.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())
