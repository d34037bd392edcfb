"""Reorder alerts: safety stock, projected stock, level, quantity and priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.functions.joins import lookup
from anaquel.functions.numeric import rnd
from anaquel.operators.star import last_date
from anaquel.settings import (
    ALTO,
    CRITICO,
    MEDIO,
    OK,
    PUNTOS_NIVEL,
    PUNTOS_PROBABILIDAD,
    SERIE,
    Params,
)


def demand_dispersion(fact: DataFrame) -> DataFrame:
    """Sample standard deviation of daily units over the whole dense history."""
    return fact.groupBy(*SERIE).agg(F.stddev_samp("unidades").alias("desviacion"))


def current_situation(
    fact: DataFrame,
    calendar: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    params: Params = Params(),
) -> DataFrame:
    """Stock on the last day with the safety stock of each series.

    Dispersion and last-day stock come out of the same aggregate, so the fact is read once.
    """
    per_series = (
        fact.groupBy(*SERIE)
        .agg(
            F.stddev_samp("unidades").alias("desviacion"),
            F.max("fecha").alias("_dia"),
            F.max_by("stock", "fecha").cast("double").alias("stock"),
            F.max_by("en_camino", "fecha").cast("double").alias("en_camino"),
        )
        .where(F.col("_dia") == last_date(calendar))
    )
    with_store = lookup(per_series, stores, ["tienda_id"], ["tienda", "lead_time"])
    described = lookup(
        with_store, products, ["sku"], [F.col("nombre").alias("producto"), "categoria"]
    )
    dispersion = F.coalesce("desviacion", F.lit(0.0))
    return described.select(
        *SERIE, "tienda", "lead_time", "producto", "categoria",
        "stock", "en_camino", dispersion.alias("desviacion"),
        rnd(F.lit(params.z_servicio) * dispersion * F.sqrt("lead_time"), 2).alias("stock_seguridad"),
    )


def alerts(
    situation: DataFrame,
    forecast: DataFrame,
    probability: DataFrame,
    params: Params = Params(),
) -> DataFrame:
    """Reorder point, projected stock and level of each series for every horizon."""
    demand = forecast.where(F.col("horizonte").isin(*params.horizontes)).select(
        *SERIE, "horizonte", F.col("demanda_acumulada").alias("demanda_prevista")
    )
    joined = situation.join(demand, SERIE).join(probability, SERIE, "left")
    left_over = F.col("stock") + F.col("en_camino") - F.col("demanda_prevista")
    reorder = F.col("demanda_prevista") + F.col("stock_seguridad")
    return joined.select(
        "tienda_id", "tienda", "sku", "producto", "categoria", "horizonte",
        "stock", "en_camino", "lead_time", "demanda_prevista", "stock_seguridad",
        rnd(reorder, 2).alias("punto_pedido"),
        rnd(left_over, 2).alias("proyectado"),
        F.coalesce("probabilidad", F.lit(0.0)).alias("probabilidad"),
        level(left_over, F.col("stock_seguridad"), reorder).alias("nivel"),
    )


def level(left_over: Column, safety: Column, reorder: Column) -> Column:
    """Alert level of a projection; every bound but zero belongs to the milder level."""
    return (
        F.when(left_over <= 0, CRITICO)
        .when(left_over < safety, ALTO)
        .when(left_over < reorder, MEDIO)
        .otherwise(OK)
    )


def risk_fact(alerts_df: DataFrame, products: DataFrame) -> DataFrame:
    """Suggested order quantity, value at risk and priority of every alert."""
    priced = lookup(alerts_df, products, ["sku"], ["precio", "lote_minimo"])
    missing = F.ceil(F.col("punto_pedido") - F.col("stock") - F.col("en_camino"))
    quantity = F.when(F.col("nivel") == OK, F.lit(0)).otherwise(
        F.greatest(missing, F.col("lote_minimo").cast("bigint"))
    ).cast("bigint")
    points = F.lit(PUNTOS_NIVEL[OK])
    for name in (MEDIO, ALTO, CRITICO):
        points = F.when(F.col("nivel") == name, PUNTOS_NIVEL[name]).otherwise(points)
    return (
        priced.withColumn("cantidad_sugerida", quantity)
        .withColumn("valor_en_riesgo", rnd(F.col("cantidad_sugerida") * F.col("precio"), 2))
        .withColumn("prioridad", points + F.col("probabilidad") * PUNTOS_PROBABILIDAD)
        .select(
            *alerts_df.columns, "cantidad_sugerida", "valor_en_riesgo",
            F.col("prioridad").cast("double").alias("prioridad"),
        )
    )


def risk_by_level(risk: DataFrame, horizon: int = 7) -> DataFrame:
    """Alerts per level at one horizon."""
    return risk.where(F.col("horizonte") == horizon).groupBy("nivel").agg(F.count("*").alias("n"))
