"""The dense fact as runs of equal days: what most series do on most days is nothing.

A run holds the days ``desde`` to ``hasta`` of one series on which all measures are the same; the runs of
a series cover the calendar without a gap. They are made from the days that have sales or inventory, without
unfolding the others, and sums over days are sums over runs times their overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.operators.star import _all_series, by_series
from anaquel.settings import SERIE, SERIE_DIA

MEDIDAS = {"unidades": "bigint", "importe": "double", "stock": "int", "en_camino": "int", "quiebre": "boolean"}


def _measures(of: dict[str, Column]) -> Column:
    return F.struct(*(of[m].cast(kind).alias(m) for m, kind in MEDIDAS.items()))


def fact_runs(
    calendar: DataFrame, stores: DataFrame, products: DataFrame, daily: DataFrame, inventory: DataFrame
) -> DataFrame:
    """``tienda_id, sku, desde, hasta`` and the measures: the same fact as ``star.dense_fact``, folded.

    All is placed by series once: events are joined, gaps between them become one run of zeros each, and
    neighbours that are equal become one. ``inventory`` must be placed by series, as ``merge_inventory`` leaves it.
    """
    first, last = (calendar.agg(f("fecha")).scalar() for f in (F.min, F.max))
    zero = {m: F.lit(False) if kind == "boolean" else F.lit(0) for m, kind in MEDIDAS.items()}
    events = (
        by_series(daily).join(inventory, SERIE_DIA, "full")
        .where(F.col("fecha").between(first, last))
        .select(*SERIE_DIA, _measures({m: F.coalesce(m, zero[m]) for m in MEDIDAS}).alias("medidas"))
    )
    # A series without any event has one row without a day.
    known = by_series(_all_series(stores, products)).join(events, SERIE, "left")
    by_day = Window.partitionBy(*SERIE).orderBy("fecha")
    before = F.lag("fecha").over(by_day)
    after = F.lead("fecha").over(by_day)
    nothing = _measures(zero)

    def run(start: Column, end: Column, measures: Column) -> Column:
        return F.struct(start.alias("desde"), end.alias("hasta"), measures.alias("medidas"))

    day = F.col("fecha")
    pieces = F.when(day.isNull(), F.array(run(first, last, nothing))).otherwise(F.array(
        run(F.when(before.isNull(), first), F.date_sub(day, 1), nothing),
        run(day, day, F.col("medidas")),
        run(F.date_add(day, 1), F.coalesce(F.date_sub(after, 1), last), nothing),
    ))
    unfolded = (
        known.select(*SERIE, pieces.alias("trozos")).select(*SERIE, F.inline("trozos"))
        .where("desde <= hasta")
    )
    by_start = Window.partitionBy(*SERIE).orderBy("desde")
    starts = F.lag("medidas").over(by_start).eqNullSafe(F.col("medidas"))
    numbered = unfolded.withColumn("_nuevo", (~starts).cast("int")).withColumn(
        "_tramo", F.sum("_nuevo").over(by_start)
    )
    return numbered.groupBy(*SERIE, "_tramo").agg(
        F.min("desde").alias("desde"), F.max("hasta").alias("hasta"), F.first("medidas").alias("medidas")
    ).select(*SERIE, "desde", "hasta", "medidas.*")


def unfold(runs: DataFrame) -> DataFrame:
    """One row per day: the dense fact."""
    days = runs.withColumn("fecha", F.explode(F.sequence("desde", "hasta")))
    return days.select("fecha", *SERIE, *MEDIDAS)


def _days(start: Column, end: Column) -> Column:
    return F.greatest(F.date_diff(end, start) + 1, F.lit(0)).cast("bigint")


def dispersion(runs: DataFrame) -> DataFrame:
    """Sample deviation of the daily units of each series, from whole-number sums over its runs."""
    n = _days(F.col("desde"), F.col("hasta"))
    u = F.col("unidades")
    sums = runs.groupBy(*SERIE).agg(
        F.sum(n).alias("n"), F.sum(n * u).alias("s"), F.sum((n * u * u).cast("decimal(38,0)")).alias("q")
    )
    spread = F.col("n") * F.col("q").cast("double") - F.col("s").cast("double") * F.col("s")
    return sums.select(
        *SERIE, F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), F.col("n") * (F.col("n") - 1))).alias("desviacion")
    )


def trailing_means(runs: DataFrame, day: Column, widths: tuple[int, ...] = (7, 28)) -> DataFrame:
    """Mean daily units of each series over the days before ``day``, as many as the widths say or as there are."""

    def mean(width: int) -> Column:
        start = F.greatest("desde", F.date_sub(day, width))
        n = _days(start, F.least("hasta", F.date_sub(day, 1)))
        return F.coalesce(F.try_divide(F.sum(n * F.col("unidades")), F.sum(n)), F.lit(0.0)).alias(f"media_{width}")

    near = runs.where((F.col("hasta") >= F.date_sub(day, max(widths))) & (F.col("desde") <= day))
    return near.groupBy(*SERIE).agg(*map(mean, widths))
