"""Demand forecast: seasonal moving average, back-test and horizon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.functions.joins import with_calendar
from anaquel.functions.numeric import rnd
from anaquel.operators.star import add_factors, last_date
from anaquel.settings import SERIE

def deseasonalised(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Daily units with both seasonal factors divided out."""
    factors = ["factor_dia", "indice_ine"]
    return with_calendar(
        fact.select("fecha", "tienda_id", "sku", "unidades"), calendar, factors
    ).select(
        "fecha", "tienda_id", "sku", "unidades", *factors,
        F.try_divide("unidades", F.col("factor_dia") * F.col("indice_ine")).alias("sin_estacion"),
    )


def forecast_daily(series: DataFrame) -> DataFrame:
    """Plain and seasonal forecast of each day from the seven rows before it (0 on the first day).

    The input must be dense: rows are days only because no day is missing.
    """
    week = Window.partitionBy(*SERIE).orderBy("fecha").rowsBetween(-7, -1)

    def trailing(column: str) -> Column:
        return F.coalesce(F.avg(column).over(week), F.lit(0.0))

    averaged = series.withColumns(
        {"_base": trailing("unidades"), "_limpia": trailing("sin_estacion")}
    )
    return averaged.select(
        "fecha", "tienda_id", "sku", "unidades",
        rnd("_base", 3).alias("pred_base"),
        rnd(F.col("_limpia") * F.col("factor_dia") * F.col("indice_ine"), 3).alias("pred_modelo"),
    )


def backtest(forecast: DataFrame, calendar: DataFrame, days: int = 7) -> DataFrame:
    """Errors of both forecasts over the last ``days`` days."""
    base = F.abs(F.col("pred_base") - F.col("unidades"))
    seasonal = F.abs(F.col("pred_modelo") - F.col("unidades"))
    return forecast.where(F.col("fecha") > F.date_sub(last_date(calendar), days)).agg(
        F.count("*").alias("observaciones"),
        rnd(F.avg(base), 4).alias("mae_base"),
        rnd(F.avg(seasonal), 4).alias("mae_modelo"),
        rnd(F.try_divide(F.sum(seasonal), F.sum("unidades")), 4).alias("wape_modelo"),
    )


def uplift(metrics: DataFrame) -> DataFrame:
    """Improvement of the seasonal forecast over the plain one, in percent."""
    gain = F.try_divide(F.col("mae_base") - F.col("mae_modelo"), F.col("mae_base")) * 100
    return metrics.select("mae_base", "mae_modelo", rnd(gain, 4).alias("mejora_pct"))


def future_calendar(
    calendar: DataFrame, month_factor: DataFrame, weekday_factor: DataFrame, days: int
) -> DataFrame:
    """The ``days`` days after the last one, with their factors; empty if there is no last day."""
    ahead = (
        calendar.agg(F.max("fecha").alias("ultima"))
        .where("ultima IS NOT NULL")
        .select("ultima", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("horizonte"))
        .select("horizonte", F.date_add("ultima", F.col("horizonte")).alias("fecha"))
    )
    return add_factors(ahead, month_factor, weekday_factor).select(
        "horizonte", "fecha", "factor_dia", "indice_ine"
    )


def current_level(forecast: DataFrame, calendar: DataFrame) -> DataFrame:
    """Level of each series: the last day's seasonal forecast with its factors divided out."""
    today = forecast.where(F.col("fecha") == last_date(calendar))
    return with_calendar(
        today.select("fecha", *SERIE, "pred_modelo"), calendar, ["factor_dia", "indice_ine"]
    ).select(
        *SERIE,
        F.try_divide("pred_modelo", F.col("factor_dia") * F.col("indice_ine")).alias("nivel"),
    )


def forecast_horizon(level: DataFrame, future: DataFrame) -> DataFrame:
    """Demand and accumulated demand of each series for every future day.

    The future is a handful of days, held as one array and unfolded on each series in place.
    """
    days = future.agg(F.collect_list(F.struct("horizonte", "fecha", "factor_dia", "indice_ine")))
    unfolded = level.select(*SERIE, "nivel", F.inline(days.scalar()))
    demand = F.greatest(F.col("nivel") * F.col("factor_dia") * F.col("indice_ine"), F.lit(0.0))
    so_far = (
        Window.partitionBy(*SERIE)
        .orderBy("horizonte")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return unfolded.withColumn("_demanda", demand).select(
        *SERIE, "horizonte", "fecha",
        rnd("_demanda", 3).alias("demanda"),
        rnd(F.sum("_demanda").over(so_far), 3).alias("demanda_acumulada"),
    )
