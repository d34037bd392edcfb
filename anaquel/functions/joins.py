"""Fact-to-dimension joins that stay safe for large dimensions and hot keys."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.session import stage

# Every executor holds a broadcast side in memory next to its tasks; a few of this size are safe.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

_sizes: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def measured_bytes(dim: DataFrame) -> int:
    """Size of a frame from its actual values: their text length and 16 bytes each.

    Planner estimates are no bound for derived frames, so the rows are measured, by one distributed
    aggregate per frame. In a cycle the dimensions are stored tables and this reads no lineage.
    """
    if dim not in _sizes:
        width = F.lit(0).cast("bigint")
        for name in dim.columns:
            text = F.octet_length(F.col(name).cast("string"))
            width = width + F.coalesce(text, F.lit(0)) + 16
        _sizes[dim] = dim.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return _sizes[dim]


def fits(dim: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether a frame is small enough to be broadcast or held as one array."""
    return measured_bytes(dim) <= max_bytes


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    columns: list[str] | list[Column],
    how: str = "inner",
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Add ``columns`` of ``dim`` to ``fact`` by equality on ``on``; ``how`` is inner or left.

    A dimension within ``max_bytes`` is broadcast and the fact does not move. A larger one is
    joined by shuffle. There adaptive execution splits a partition that one key fills, by the map tasks
    its rows come from, so copies of one and the same row are spread as well (a salt made from the row
    would send them all one way), and no other key pays for it. It does so only if both sides come straight from a
    shuffle of the join's own, which a dimension that is an aggregate by the key does not: so it is stored first.
    """
    side = dim.select(*on, *columns)
    if fits(dim, max_bytes):
        return fact.join(F.broadcast(side), on, how)
    return fact.join(stage(side, "dimension").hint("merge"), on, how)


def with_calendar(df: DataFrame, calendar: DataFrame, columns: list[str]) -> DataFrame:
    """Join by day to a calendar; one too long to be broadcast is joined by shuffle."""
    return lookup(df, calendar, ["fecha"], columns)
