"""Features, labels and the rule baseline of the stock-out classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from anaquel.functions.joins import lookup
from anaquel.functions.numeric import count_if, flag, rnd
from anaquel.settings import COBERTURA_MAXIMA, SERIE, Params

def feature_rows(
    fact: DataFrame, products: DataFrame, stores: DataFrame, params: Params = Params()
) -> DataFrame:
    """Trailing features per series and day, ending yesterday, and the label of the next 7 days.

    All frames share one partitioning and order, so they cost one sort and no further shuffle
    when the fact is placed by series. The dimensions are joined after the windows.
    """

    by_day = Window.partitionBy(*SERIE).orderBy("fecha")

    def past(days: int) -> WindowSpec:
        return by_day.rowsBetween(-days, -1)

    base = fact.select(
        "fecha", *SERIE,
        F.col("unidades").cast("double").alias("_u"),
        F.col("stock").cast("double").alias("stock"),
        F.col("en_camino").cast("double").alias("en_camino"),
        flag(F.col("quiebre")).alias("_q"),
    )
    next_week = by_day.rowsBetween(1, 7)
    label = F.max("_q").over(next_week)
    if params.full_horizon_only:
        label = F.when(F.count("_q").over(next_week) == 7, label)
    trailing = base.withColumns({
        "media_7": F.avg("_u").over(past(7)),
        "media_28": F.avg("_u").over(past(28)),
        "desv_14": F.stddev_samp("_u").over(past(14)),
        "quiebres_14": F.sum("_q").over(past(14)),
        "etiqueta": label,
    })
    with_product = lookup(trailing, products, ["sku"], ["categoria"])
    with_store = lookup(
        with_product, stores, ["tienda_id"], [F.col("lead_time").cast("double").alias("lead_time")]
    )
    filled = with_store.select(
        "fecha", *SERIE, "categoria", "lead_time", "stock", "en_camino",
        *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("media_7", "media_28", "desv_14")),
        F.coalesce("quiebres_14", F.lit(0)).cast("bigint").alias("quiebres_14"),
        F.col("etiqueta").cast("int").alias("etiqueta"),
    )
    return filled.withColumn("dias_cobertura", _days_of_cover())


def _days_of_cover() -> Column:
    """Days the stock lasts at the weekly pace; the ceiling when there is no pace."""
    ceiling = F.lit(float(COBERTURA_MAXIMA))
    return F.when(
        F.col("media_7") > 0, F.least(F.try_divide("stock", "media_7"), ceiling)
    ).otherwise(ceiling)


def labelled(features: DataFrame) -> DataFrame:
    return features.where(F.col("etiqueta").isNotNull())


def split_summary(features: DataFrame, params: Params = Params()) -> DataFrame:
    """One row: the time cut, the rows on both sides of it, and the class balance of training.

    The features are read once and reduced to one row per day; the cut is found on those. The
    weight is negatives over positives; it is NULL, and ``entrenable`` false, if a class is missing.
    """
    per_day = (
        labelled(features)
        .groupBy("fecha")
        .agg(F.count("*").alias("filas"), F.sum(F.col("etiqueta").cast("bigint")).alias("positivas"))
    )
    cut = F.date_sub(per_day.agg(F.max("fecha")).scalar(), params.dias_test)
    dated = per_day.withColumn("corte", cut)
    train = F.col("fecha") <= F.date_sub("corte", params.embargo_days)
    test = F.col("fecha") > F.col("corte")

    def total(column: str, side: Column) -> Column:
        return F.coalesce(F.sum(F.when(side, F.col(column))), F.lit(0))

    sides = dated.agg(
        F.max("corte").alias("corte"),
        total("filas", train).alias("entrenamiento"),
        total("positivas", train).alias("positivos"),
        total("filas", test).alias("prueba"),
        total("positivas", test).alias("positivos_prueba"),
    )
    negatives = F.col("entrenamiento") - F.col("positivos")
    both = (F.col("positivos") > 0) & (negatives > 0)
    return sides.withColumns({
        "entrenable": both,
        "peso_positivos": F.when(both, F.try_divide(negatives, F.col("positivos"))),
    })


def split(
    features: DataFrame, cut: Column, params: Params = Params()
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows on the two sides of the cut."""
    rows = labelled(features)
    return (
        rows.where(F.col("fecha") <= F.date_sub(cut, params.embargo_days)),
        rows.where(F.col("fecha") > cut),
    )


def weighted(rows: DataFrame, weight: float) -> DataFrame:
    """Add ``peso``: ``weight`` on stock-outs, 1 elsewhere."""
    return rows.withColumn("peso", F.when(F.col("etiqueta") == 1, F.lit(float(weight))).otherwise(1.0))


def confusion(warned: Column, suffix: str = "") -> list[Column]:
    """True/false positives and negatives of a warning against ``etiqueta``, as aggregates."""
    real = F.col("etiqueta") == 1
    calm = F.col("etiqueta") == 0
    return [
        count_if(real & warned).alias(f"vp{suffix}"),
        count_if(calm & warned).alias(f"fp{suffix}"),
        count_if(real & ~warned).alias(f"fn{suffix}"),
        count_if(calm & ~warned).alias(f"vn{suffix}"),
    ]


def hit_rates(suffix: str = "") -> list[Column]:
    """Precision and recall from the confusion counts; 0 where nothing was warned or happened."""

    def rate(other: str) -> Column:
        hits = F.col(f"vp{suffix}")
        return F.coalesce(rnd(F.try_divide(hits, hits + F.col(f"{other}{suffix}")), 4), F.lit(0.0))

    return [rate("fp").alias(f"precision{suffix}"), rate("fn").alias(f"recall{suffix}")]


def rule_warns() -> Column:
    """The rule the model is compared with: the cover does not outlast the lead time."""
    return F.col("dias_cobertura") <= F.col("lead_time")


def rule_baseline(test: DataFrame) -> DataFrame:
    """Confusion counts, precision and recall of the days-of-cover rule."""
    counts = test.agg(*confusion(rule_warns(), "_regla")[:3])
    return counts.select("*", *hit_rates("_regla"))
