"""Stateful aggregates of the sales stream: the preferred delivery of each sale, latency by minute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.operators.silver import PREFERENCIA
from anaquel.streaming.ingest import ACEPTADA

MINUTO = "1 minute"


def preferred_deliveries(sales: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Of a sale's deliveries that follow each other within ``delay``, the one the batch rules prefer.

    The order is that of ``silver.clean_sales``, so a delivery that arrives later still wins if it is the
    better one. Only accepted sales with an id can be copies of each other; any other message counts as
    itself, by its place in the log. ``entregas`` counts the deliveries. A row leaves once the watermark on the
    time of arrival has passed its last delivery by ``delay``; until then one row per sale is the state, whatever the number of
    deliveries, and map tasks send one row per sale (an option of ``session.configure``).
    """
    itself = F.concat_ws(":", F.lit("#"), "particion", "offset_kafka")
    known = (F.col("estado") == ACEPTADA) & F.col("venta_id").isNotNull()
    order = [c for c in PREFERENCIA if c in sales.columns]
    # Structs compare field by field, nulls first, as the batch order does.
    best = F.min(F.struct(*order, *(c for c in sales.columns if c not in order)))
    return (
        sales.withColumn("_clave", F.when(known, F.concat(F.lit("="), "venta_id")).otherwise(itself))
        .withWatermark("recibido", delay)
        .groupBy(F.session_window("recibido", delay), "_clave")
        .agg(best.alias("v"), F.count("*").alias("entregas"))
        .select(*(F.col(f"v.{c}").alias(c) for c in sales.columns), "entregas")
    )


def latency_by_minute(sales: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Accepted sales by minute of arrival: how many, how long after the sale, and the newest sale.

    The sums are exact (microseconds), so minutes add up to any longer time (``latency_total``). In update mode a
    minute is sent again whenever it changes; state is kept for ``delay`` behind the newest arrival, and as the
    watermark runs on arrivals, no sale is late. Sales without a time of sale count, but not in the waits.
    """
    wait = F.unix_micros("recibido") - F.unix_micros("momento")
    return (
        sales.where(F.col("estado") == ACEPTADA)
        .withWatermark("recibido", delay)
        .groupBy(F.window("recibido", MINUTO).alias("_minuto"))
        .agg(
            F.count("*").alias("ventas"),
            F.count(wait).alias("medidas"),
            F.sum(wait).alias("espera_us"),
            F.max(wait).alias("espera_max_us"),
            F.max("momento").alias("ultima_venta"),
        )
        .select(F.col("_minuto.start").alias("minuto"), *LATENCIA)
    )


LATENCIA = ("ventas", "medidas", "espera_us", "espera_max_us", "ultima_venta")


def current_minutes(updates: DataFrame) -> DataFrame:
    """The last state of every minute among landed updates (column ``lote``)."""
    newest = F.max_by(F.struct(*LATENCIA), F.col("lote"))
    return updates.groupBy("minuto").agg(newest.alias("v")).select("minuto", "v.*")


def latency_total(minutes: DataFrame) -> DataFrame:
    """One row: sales, mean and greatest wait in seconds, the newest sale."""
    return minutes.agg(
        F.coalesce(F.sum("ventas"), F.lit(0)).alias("ventas"),
        F.try_divide(F.sum("espera_us"), F.sum("medidas") * 1_000_000).alias("latencia_seg"),
        (F.max("espera_max_us") / 1_000_000).alias("latencia_max_seg"),
        F.max("ultima_venta").alias("ultima_venta"),
    )
