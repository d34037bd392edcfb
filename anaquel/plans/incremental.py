"""Daily tables kept up to date from what has changed, as versions of one folder.

Sales, daily totals, the dense fact, forecasts and features are stored by period (month) of their day. A refresh reads
the sales that landed after the high-water mark of the current version, finds the days they change, and writes
again only the periods that hold such days or days whose windows reach one. All other periods stay the
folders they are, as do sales of periods that lose none: new ones go beside them. The result equals a build from all inputs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.functions.joins import fits
from anaquel.operators import features, forecast, silver, star
from anaquel.session import configure, size_series, stage
from anaquel.settings import Params
from anaquel.sources import snapshots

MARCA, PRIMERA, ULTIMA = "marca", "primera", "ultima"
#: Days before and after a day that its row is made from: trailing averages, and the label of the next week.
ALCANCE_PRONOSTICO = (7, 0)
ALCANCE_VARIABLES = (28, 7)


@dataclass(frozen=True)
class Fixed:
    """What a refresh takes as given; another catalogue, list of stores or factors needs a new build."""

    catalog: DataFrame
    stores: DataFrame
    month_factor: DataFrame
    weekday_factor: DataFrame


def build(
    spark: SparkSession, out: str, fixed: Fixed, history: DataFrame, landed: DataFrame,
    inventory: DataFrame | Callable[[DataFrame], DataFrame], params: Params = Params(),
) -> snapshots.Version:
    """All tables from all inputs, as a version; ``inventory`` has one row per day and series, or makes it from the clean sales."""
    configure(spark)
    draft = snapshots.begin(spark, out)
    products = star.dim_product(fixed.catalog)
    reviewed = silver.review_sales(silver.unify_sales(history, landed), products)
    draft.save_periods("ventas", silver.clean_sales(reviewed))
    rows = inventory if isinstance(inventory, DataFrame) else inventory(draft.table("ventas"))
    draft.save_periods("inventario", rows)
    draft.save_periods("diario", star.sales_daily(draft.table("ventas").where("fecha IS NOT NULL")))
    mark = landed.agg(F.max("recibido")).first()[0]
    _derive(draft, fixed, None, params)
    _note_mark(draft, mark)
    return draft.commit()


def refresh(
    spark: SparkSession, out: str, fixed: Fixed, landed: DataFrame, inventory: DataFrame | None = None,
    params: Params = Params(),
) -> snapshots.Version:
    """A version with the sales that landed since the current one, and with new inventory rows.

    ``landed`` is the whole landed feed; the filter on its arrival reaches the scan. ``inventory`` has at most
    one row per day and series, which beats the stored one. Copies of stored sales are settled as in a full build: the
    preferred one stays, and both its day and the day of the one it replaces count as changed.
    """
    configure(spark)
    draft = snapshots.begin(spark, out)
    base = draft.base
    if base is None:
        raise ValueError(f"{out} has no version to refresh")
    fresh = landed
    if base.notes.get(MARCA):
        fresh = landed.where(F.col("recibido") > F.lit(base.notes[MARCA]).cast("timestamp"))
    products = star.dim_product(fixed.catalog)
    batch = _batch(fresh, products)
    mark = fresh.agg(F.max("recibido")).first()[0] or base.notes.get(MARCA)

    plus, minus = _changes(base.table(spark, "ventas"), batch)
    losing = _days(minus.select("fecha"))
    days = losing | _days(plus.select("fecha"))
    touched = _periods(days)
    if touched:
        if base.scattered(spark, "ventas", touched):
            draft.save_periods("ventas", _settled(base.table(spark, "ventas", touched), plus, minus), touched)
        else:  # only periods that lose sales are written again; the others' files stay, with new ones beside them
            again = set(_periods(losing))
            stored = base.table(spark, "ventas", sorted(again)) if again else base.table(spark, "ventas").limit(0)
            kept = _without(stored, minus)
            plus = plus.select(*kept.columns)
            draft.save_periods("ventas", plus, touched, placed=kept, extended=[p for p in touched if p not in again])
        daily = star.sales_daily(draft.table("ventas", touched).where("fecha IS NOT NULL"))
        draft.save_periods("diario", daily, touched)
    else:
        draft.keep("ventas")
        draft.keep("diario")
    if inventory is None:
        draft.keep("inventario")
    else:
        counted = _days(inventory.select("fecha"))
        stored = base.table(spark, "inventario", _periods(counted))
        merged = stored.join(inventory.select(*star.SERIE_DIA), star.SERIE_DIA, "left_anti").select(*stored.columns)
        draft.save_periods("inventario", merged.union(inventory.select(*stored.columns)), _periods(counted))
        days = days | counted
    _derive(draft, fixed, days - {None}, params)
    _note_mark(draft, mark)
    return draft.commit()


def with_landed(stored: DataFrame, landed: DataFrame, products: DataFrame) -> DataFrame:
    """Clean sales as ``silver.clean_sales`` has them from all rows, those of ``stored`` being clean already.

    The best of all copies of a sale is the best of the new ones and of the best so far: only sales that ``landed`` has a
    copy of are settled again, the others neither move nor are they sorted.
    """
    return _settled(stored, *_changes(stored, _batch(landed, products)))


def _batch(landed: DataFrame, products: DataFrame) -> DataFrame:
    """Valid rows of a landed feed, stored."""
    reviewed = silver.review_sales(silver.unify_sales(landed.limit(0), landed), products)
    return stage(reviewed.where("motivo_rechazo IS NULL"), "lote")


def _settled(stored: DataFrame, plus: DataFrame, minus: DataFrame) -> DataFrame:
    return _without(stored, minus).union(plus.select(*stored.columns))


def _without(stored: DataFrame, minus: DataFrame) -> DataFrame:
    return stored.join(_few(minus.select("venta_id")), "venta_id", "left_anti").select(*stored.columns)


def _changes(stored: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that a batch adds to the stored sales, and rows that it takes away.

    Only stored rows with an id of the batch are looked at; ids are sent to the stored sales, not these to the ids,
    while they are few enough. More of them meet the stored ids alone, and those found go to the stored sales.
    """
    ids = stage(batch.select("venta_id").distinct(), "ids")
    if not fits(ids):
        ids = stage(stored.select("venta_id").join(ids, "venta_id", "left_semi").distinct(), "hallados")
    rivals = stored.join(_few(ids), "venta_id", "left_semi").select(*stored.columns)
    rivals = stage(rivals, "rivales")
    no_reason = F.lit(None).cast("string").alias("motivo_rechazo")
    everyone = batch.unionByName(rivals.drop("fecha").select("*", no_reason))
    winners = stage(silver.clean_sales(everyone).select(*stored.columns), "ganadoras")
    return stage(winners.exceptAll(rivals), "entran"), stage(rivals.exceptAll(winners), "salen")


def _few(ids: DataFrame) -> DataFrame:
    """Stored ids, broadcast if they are few enough."""
    return F.broadcast(ids) if fits(ids) else ids


def _derive(draft: snapshots.Draft, fixed: Fixed, changed: set[dt.date] | None, params: Params) -> None:
    """Calendar, fact, forecasts and features around the changed days (None: all days)."""
    spark = draft.spark
    daily = draft.table("diario")
    span = daily.agg(F.min("fecha"), F.max("fecha")).first()
    calendar = draft.save("dim_tiempo", star.dim_date(daily, fixed.month_factor, fixed.weekday_factor))
    first, last = span
    draft.notes[PRIMERA], draft.notes[ULTIMA] = str(first), str(last)
    stores, products = star.dim_store(fixed.stores), star.dim_product(fixed.catalog)
    size_series(spark, calendar.count(), stores.count(), products.count())
    all_days = set(_range(first, last))
    if changed is None:
        touched = all_days
    else:  # days that the calendar has gained or lost change as well
        notes = draft.base.notes
        before = set(_range(dt.date.fromisoformat(notes[PRIMERA]), dt.date.fromisoformat(notes[ULTIMA])))
        touched = (changed & (all_days | before)) | (all_days ^ before)

    def rebuilt(name: str, days: set[dt.date], rows: Callable[[list[dt.date]], DataFrame]) -> None:
        """Write the periods of ``days`` again, whole."""
        if changed is not None and not days:
            draft.keep(name)
            return
        periods = _periods(days)
        wanted = sorted(d for d in all_days if d.strftime("%Y-%m") in set(periods))
        draft.save_periods(name, rows(wanted), None if changed is None else periods)

    def fact(days: list[dt.date]) -> DataFrame:
        slots = _periods(days)
        return star.dense_fact(
            calendar, stores, products, draft.table("diario", slots),
            star.by_series(draft.table("inventario", slots)), days=_array(days),
        )

    def windows(reach: tuple[int, int], rows: Callable[[DataFrame], DataFrame]) -> Callable[[list[dt.date]], DataFrame]:
        """Rows of the days, from the fact of these days and of those in their reach.

        Each day kept has its whole reach in the input, so rows before it are the days before it.
        """
        def of(days: list[dt.date]) -> DataFrame:
            needed = _around(days, reach) & all_days
            source = draft.table("hecho", _periods(needed)).where(_among(needed))
            return rows(star.by_series(source)).where(_among(days))
        return of

    rebuilt("hecho", touched, fact)
    # A day's row changes if a changed day is in its reach.
    for name, reach, rows in (
        ("pronostico", ALCANCE_PRONOSTICO,
         lambda f: forecast.forecast_daily(forecast.deseasonalised(f, calendar))),
        ("variables", ALCANCE_VARIABLES, lambda f: features.feature_rows(f, products, stores, params)),
    ):
        back, ahead = reach
        rebuilt(name, _around(touched, (ahead, back)), windows(reach, rows))


def _note_mark(draft: snapshots.Draft, mark: object) -> None:
    if mark is not None:
        draft.notes[MARCA] = str(mark)


def _days(rows: DataFrame) -> set[dt.date | None]:
    """The different days of some rows: never more than there are days."""
    return {r.fecha for r in rows.distinct().collect()}


def _periods(days: Iterable[dt.date | None]) -> list[str]:
    return sorted({"sin fecha" if d is None else d.strftime("%Y-%m") for d in days})


def _range(first: dt.date | None, last: dt.date | None) -> Iterable[dt.date]:
    if first is not None:
        for n in range((last - first).days + 1):
            yield first + dt.timedelta(n)


def _around(days: Iterable[dt.date], reach: tuple[int, int]) -> set[dt.date]:
    """Days, with as many before and after each."""
    back, ahead = reach
    return {d + dt.timedelta(n) for d in days for n in range(-back, ahead + 1)}


def _spans(days: Iterable[dt.date]) -> list[tuple[Column, Column]]:
    """First and last day of each unbroken span."""
    spans: list[list[dt.date]] = []
    for d in sorted(days):
        if spans and d - spans[-1][1] == dt.timedelta(1):
            spans[-1][1] = d
        else:
            spans.append([d, d])
    return [(F.lit(a), F.lit(b)) for a, b in spans]


def _array(days: Iterable[dt.date]) -> Column:
    spans = [F.sequence(a, b) for a, b in _spans(days)]
    return F.flatten(F.array(*spans)) if spans else F.array().cast("array<date>")


def _among(days: Iterable[dt.date]) -> Column:
    return reduce(Column.__or__, (F.col("fecha").between(a, b) for a, b in _spans(days)), F.lit(False))
