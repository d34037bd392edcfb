"""Silver layer: unify, validate and deduplicate sales; report their quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel import schemas
from anaquel.functions.joins import lookup
from anaquel.functions.numeric import count_if, rnd
from anaquel.session import series_partitions
from anaquel.settings import (
    HISTORICO,
    IMPORTE_MAXIMO,
    IMPORTE_NO_VALIDO,
    PRECIO_NO_VALIDO,
    SERIE,
    SERIE_DIA,
    SIN_IDENTIFICADOR,
    SKU_NO_CATALOGADO,
    STREAMING,
    UNIDADES_NO_VALIDAS,
)

INGESTA = ("recibido", "particion", "offset_kafka")

# Which copy of a sale wins: history before stream, then the earliest, then a total order over
# what is left, so that the survivor never depends on task order.
PREFERENCIA = (
    "origen", "momento", "recibido", "particion", "offset_kafka",
    "tienda_id", "sku", "unidades", "precio", "importe",
)


def unify_sales(history: DataFrame, landed: DataFrame) -> DataFrame:
    """History and landed stream as one bag of rows, tagged with ``origen``."""
    types = {f.name: f.dataType for f in schemas.VENTA_STREAM.fields}
    sale = schemas.VENTA.fieldNames()
    past = history.select(
        *sale,
        *(F.lit(None).cast(types[c]).alias(c) for c in INGESTA),
        F.lit(HISTORICO).alias("origen"),
    )
    live = landed.select(
        *sale,
        *(F.col(c).try_cast(types[c]).alias(c) for c in INGESTA),
        F.lit(STREAMING).alias("origen"),
    )
    return past.unionByName(live)


def review_sales(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add ``motivo_rechazo``: the first rule a row breaks, NULL for a valid row."""

    def not_positive(column: str) -> Column:
        return F.col(column).isNull() | (F.col(column) <= 0)

    def no_amount(column: str) -> Column:
        """Too large to be an amount; NaN compares as larger than any number."""
        return F.abs(F.col(column)) >= IMPORTE_MAXIMO

    known = catalog.select("sku").distinct()
    checked = lookup(raw, known, ["sku"], [F.lit(True).alias("_catalogado")], how="left")
    reason = (
        F.when(F.col("venta_id").isNull(), SIN_IDENTIFICADOR)
        .when(F.col("_catalogado").isNull(), SKU_NO_CATALOGADO)
        .when(not_positive("unidades"), UNIDADES_NO_VALIDAS)
        .when(not_positive("precio") | no_amount("precio"), PRECIO_NO_VALIDO)
        .when(no_amount("importe"), IMPORTE_NO_VALIDO)
    )
    return checked.select(*raw.columns, reason.alias("motivo_rechazo"))


def review_counts(reviewed: DataFrame) -> DataFrame:
    """Rows per outcome (a NULL reason is a valid row) and the last day of the history among them.

    A handful of rows from one pass; a cycle stores them and takes its reports from there.
    """
    history_day = F.when(F.col("origen") == HISTORICO, F.to_date("momento"))
    return reviewed.groupBy("motivo_rechazo").agg(
        F.count("*").alias("registros"), F.max(history_day).alias("ultima")
    )


def rejects_by_reason(reviewed: DataFrame) -> DataFrame:
    """Rejected rows per reason."""
    return rejects_from_counts(review_counts(reviewed))


def rejects_from_counts(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("motivo_rechazo").isNotNull()).select("motivo_rechazo", "registros")


def clean_sales(reviewed: DataFrame) -> DataFrame:
    """Valid sales, one row per ``venta_id``.

    Rank 1 is filtered right above the window, so Spark keeps one candidate per id in every map
    task before the shuffle; an id repeated a billion times costs one row per task.
    """
    best_first = Window.partitionBy("venta_id").orderBy(
        *(F.col(c).asc_nulls_first() for c in PREFERENCIA)
    )
    return (
        reviewed.where(F.col("motivo_rechazo").isNull())
        .withColumn("_puesto", F.row_number().over(best_first))
        .where("_puesto = 1")
        .select(
            "venta_id", "momento", F.to_date("momento").alias("fecha"), "tienda_id", "sku",
            "unidades", "precio", "importe", *INGESTA, "origen",
        )
    )


def quality_report(reviewed: DataFrame) -> DataFrame:
    """One row: received, valid, rejected, duplicated and the share of valid rows, in one pass."""
    accepted_id = F.when(F.col("motivo_rechazo").isNull(), F.col("venta_id"))
    counts = reviewed.agg(
        F.count("*").alias("entradas"),
        F.count_distinct(accepted_id).alias("validas"),
        count_if(F.col("motivo_rechazo").isNotNull()).alias("rechazadas"),
    )
    return _with_residual(counts)


def quality_from_layers(counts: DataFrame, clean: DataFrame) -> DataFrame:
    """The same report from stored outcome counts and the stored clean layer."""
    rejected = F.when(F.col("motivo_rechazo").isNotNull(), F.col("registros"))
    valid = clean.agg(F.count("*")).scalar()
    totals = counts.agg(
        F.coalesce(F.sum("registros"), F.lit(0)).alias("entradas"),
        F.coalesce(F.sum(rejected), F.lit(0)).alias("rechazadas"),
    )
    return _with_residual(totals.withColumn("validas", valid))


def _with_residual(counts: DataFrame) -> DataFrame:
    share = F.try_divide(F.col("validas"), F.col("entradas")) * 100
    return counts.select(
        "entradas", "validas", "rechazadas",
        (F.col("entradas") - F.col("validas") - F.col("rechazadas")).alias("duplicadas"),
        F.coalesce(rnd(share, 2), F.lit(0.0)).alias("calidad_pct"),
    )


def feed_freshness(history: DataFrame, as_of: Column) -> DataFrame:
    """Days between ``as_of`` and the last raw history sale, with a warning beyond one day."""
    return freshness_from_days(history.select(F.to_date("momento").alias("ultima")), as_of)


def freshness_from_days(days: DataFrame, as_of: Column) -> DataFrame:
    """The same from any frame whose ``ultima`` holds the days, such as the outcome counts."""
    gap = F.date_diff(as_of.cast("date"), F.col("ultima"))
    return days.agg(F.max("ultima").alias("ultima")).select(
        "ultima", gap.alias("dias"), (gap > 1).alias("aviso")
    )


def merge_inventory(history: DataFrame, live: DataFrame, placed: bool = False) -> DataFrame:
    """One inventory row per day, store and product; the live feed beats the history.

    Both sides are placed by series and merged there, which also serves the dense fact above: the largest
    input of a cycle is shuffled once. A history that is stored by series (``placed``) does not move at all: only
    the live feed goes to its buckets. Rows without store, product or day match nothing.
    """
    values = ("stock", "en_camino", "quiebre")
    past = _one_per_day(history if placed else _by_series(history))
    fresh = _one_per_day(_by_series(live)).select(
        *SERIE_DIA, F.struct(*values).alias("_viva")
    )
    merged = past.join(fresh, SERIE_DIA, "full")
    newest = (
        F.when(F.col("_viva").isNotNull(), F.col(f"_viva.{c}")).otherwise(F.col(c)).alias(c) for c in values
    )
    return merged.select("fecha", "tienda_id", "sku", *newest)


def _by_series(df: DataFrame) -> DataFrame:
    return df.repartition(series_partitions(df.sparkSession), *SERIE)


def _one_per_day(df: DataFrame) -> DataFrame:
    """Of the rows of a day and series the least; the window runs where the series is."""
    values = ("stock", "en_camino", "quiebre")
    least = Window.partitionBy(*SERIE_DIA).orderBy(*(F.col(c).asc_nulls_first() for c in values))
    rows = df.select(*SERIE_DIA, *values)
    return rows.withColumn("_puesto", F.row_number().over(least)).where("_puesto = 1").drop("_puesto")
