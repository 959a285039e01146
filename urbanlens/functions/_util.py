"""Small helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: inside a lambda an expression would be computed for every element."""
    return F.transform(F.array(value), body)[0]


def rounded(x: Column, places: int) -> Column:
    """``F.round(x, places)`` of doubles for billions of rows. ``round`` makes each number a decimal text; only numbers beside a tie, or
    too large for a multiplied double to tell (NaN, infinity), need that. ``x`` should be a column, it is used several times."""
    scaled = x * F.lit(10.0 ** places)
    whole = F.floor(scaled)
    sure = (F.abs(scaled) < F.lit(1e9)) & (F.abs(scaled - whole - F.lit(0.5)) > F.lit(1e-5))
    return F.when(sure, F.floor(scaled + F.lit(0.5)) / F.lit(10.0 ** places)).otherwise(F.round(x, places))
