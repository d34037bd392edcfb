"""KPIs, export and the serving queries, as functions on the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.functions.numeric import count_if, rnd
from anaquel.operators.star import last_date
from anaquel.settings import ALTO, CRITICO, MEDIO, OK, STREAMING


def kpi_risk(risk: DataFrame, horizon: int = 7) -> DataFrame:
    """Open alerts per level and their value at one horizon, in one pass over its partition."""
    level = F.col("nivel")
    return risk.where(F.col("horizonte") == horizon).agg(
        count_if(level == CRITICO).alias("criticas"),
        count_if(level == ALTO).alias("altas"),
        count_if(level == MEDIO).alias("medias"),
        rnd(F.sum(F.when(level != OK, F.col("valor_en_riesgo"))), 2).alias("valor_en_riesgo"),
    )


def kpi_stockout_rate(fact: DataFrame, calendar: DataFrame, days: int = 7) -> DataFrame:
    """Share of series-days without stock over the last ``days`` days, in percent."""
    out = F.when(F.col("quiebre"), 100.0).otherwise(0.0)
    return fact.where(F.col("fecha") > F.date_sub(last_date(calendar), days)).agg(
        rnd(F.avg(out), 2).alias("tasa_quiebre_pct")
    )


def kpi_streaming(sales: DataFrame, as_of: Column) -> DataFrame:
    """Streamed sales, their mean ingest latency and the age of the newest one."""
    delay = F.unix_timestamp("recibido") - F.unix_timestamp("momento")
    age = F.unix_timestamp(as_of) - F.unix_timestamp(F.max("momento"))
    return (
        sales.where(F.col("origen") == STREAMING)
        .agg(
            F.count("*").alias("ventas_streaming"),
            F.coalesce(rnd(F.avg(delay), 2), F.lit(0.0)).alias("latencia_ingesta_seg"),
            F.coalesce(age, F.lit(0)).alias("antiguedad_dato_seg"),
        )
        .withColumn("antiguedad_dato_min", rnd(F.col("antiguedad_dato_seg") / 60, 1))
    )


def kpis(
    calendar: DataFrame, quality: DataFrame, risk: DataFrame, fact: DataFrame,
    sales: DataFrame, as_of: Column,
) -> DataFrame:
    """The KPI row: four one-row aggregates side by side as scalars."""
    from_risk = ["criticas", "altas", "medias", "valor_en_riesgo"]
    from_sales = ["ventas_streaming", "latencia_ingesta_seg", "antiguedad_dato_seg"]

    def only_row(df: DataFrame, columns: list[str]) -> Column:
        return df.select(F.struct(*columns)).scalar()

    return (
        calendar.agg(F.max("fecha").alias("fecha"))
        .select(
            "fecha",
            quality.select("calidad_pct").scalar().alias("calidad_pct"),
            only_row(kpi_risk(risk), from_risk).alias("_r"),
            kpi_stockout_rate(fact, calendar).scalar().alias("tasa_quiebre_pct"),
            only_row(kpi_streaming(sales, as_of), from_sales).alias("_s"),
        )
        .select(
            "fecha", "calidad_pct",
            *(F.col("_r").getField(c).alias(c) for c in from_risk),
            "tasa_quiebre_pct",
            *(F.col("_s").getField(c).alias(c) for c in from_sales),
        )
    )


def open_alerts(risk: DataFrame, horizon: int = 7) -> DataFrame:
    """Alerts to act on at one horizon, most urgent first."""
    return (
        risk.where((F.col("horizonte") == horizon) & (F.col("nivel") != OK))
        .orderBy(F.desc("prioridad"), "tienda_id", "sku")
        .select(
            "tienda", "producto", "sku", "nivel", "stock", "en_camino", "demanda_prevista",
            "proyectado", "cantidad_sugerida", "valor_en_riesgo",
        )
    )


def search_alerts(
    risk: DataFrame,
    nivel: str | None = None,
    tienda_id: str | None = None,
    horizonte: int = 7,
    limite: int = 50,
) -> DataFrame:
    """The ``limite`` most urgent alerts; without ``nivel``, all levels that need action.

    Values become literals of the plan, never SQL text. Sort and limit run as one top-k, and the
    horizon prunes partitions.
    """
    if not 1 <= horizonte <= 14:
        raise ValueError("horizonte must be between 1 and 14")
    if not 1 <= limite <= 500:
        raise ValueError("limite must be between 1 and 500")
    wanted = F.col("horizonte") == horizonte
    wanted &= (F.col("nivel") == nivel) if nivel else (F.col("nivel") != OK)
    if tienda_id:
        wanted &= F.col("tienda_id") == tienda_id
    return (
        risk.where(wanted)
        .orderBy(F.desc("prioridad"), "tienda_id", "sku")
        .limit(limite)
        .select(
            "tienda", "producto", "sku", "nivel", "stock", "en_camino", "demanda_prevista",
            "proyectado", "stock_seguridad", "probabilidad", "cantidad_sugerida",
            "valor_en_riesgo",
        )
    )


def panel_alerts(risk: DataFrame, nivel: str = "Todos", horizonte: int = 7) -> DataFrame:
    """The dashboard's alert list: "Todos" is any level that needs action, at most 300 rows."""
    return search_alerts(
        risk, nivel=None if nivel == "Todos" else nivel, horizonte=horizonte, limite=300
    )


def alerts_by_store_level(
    risk: DataFrame, nivel: str = "Todos", horizonte: int = 7
) -> DataFrame:
    """Open alerts per store and level, all of them: the panel's list has a limit, its totals none."""
    wanted = (F.col("horizonte") == horizonte) & (F.col("nivel") != OK)
    if nivel != "Todos":
        wanted &= F.col("nivel") == nivel
    return risk.where(wanted).groupBy("tienda", "nivel").agg(F.count("*").alias("alertas"))


def ranked_rejects(rejects: DataFrame) -> DataFrame:
    """Reject reasons, most frequent first."""
    return rejects.orderBy(F.desc("registros"), "motivo_rechazo")


def ranked_importance(importance: DataFrame) -> DataFrame:
    """Model variables, most important first."""
    return importance.orderBy(F.desc("importancia"), "variable")


def model_report(
    rule: DataFrame, backtest: DataFrame, balance: DataFrame,
    metrics: DataFrame | None = None, importance: DataFrame | None = None,
) -> DataFrame:
    """All that is known about a cycle's models, as rows (parte, nombre, valor).

    Parts: the rule's counts and ratios, the forecast's back-test, the weight of the positive class, and,
    where a forest was trained, its metrics and the importance of its variables.
    """

    def part(name: str, row: DataFrame) -> DataFrame:
        pairs = F.array(*[
            F.struct(F.lit(c).alias("nombre"), F.col(c).cast("double").alias("valor")) for c in row.columns
        ])
        return row.select(F.lit(name).alias("parte"), F.inline(pairs))

    report = (
        part("regla", rule).union(part("pronostico", backtest))
        .union(part("clases", balance.select("peso_positivos")))
    )
    if metrics is not None:
        report = report.union(part("modelo", metrics))
    if importance is not None:
        report = report.union(
            importance.select(F.lit("importancia"), "variable", F.col("importancia").cast("double"))
        )
    return report.orderBy("parte", "nombre")


def latest_loads(manifest: DataFrame, limite: int = 30) -> DataFrame:
    """The last ``limite`` loads, newest first."""
    if not 1 <= limite <= 500:
        raise ValueError("limite must be between 1 and 500")
    return manifest.orderBy(F.desc("fecha"), "origen", "fichero").limit(limite)
