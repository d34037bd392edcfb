"""Rounding that does not depend on floating-point noise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(value: Column | str, digits: int) -> Column:
    """Round half up after settling the value on eight decimals.

    The sum of doubles depends on task order in its last bits; settling first keeps a value that
    sits on a rounding tie from flipping between two runs. What is no number, or too large to settle,
    becomes NULL; sales with such numbers are rejected, and counted, before any sum.
    """
    col = F.col(value) if isinstance(value, str) else value
    return F.round(col.try_cast("decimal(28,8)"), digits).cast("double")


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0."""
    return F.when(condition, 1).otherwise(0)


def count_if(condition: Column) -> Column:
    """Number of rows on which the condition holds; 0 on an empty input."""
    return F.count(F.when(condition, True))
