"""Mergeable moments of the daily units: dispersion over all history without reading all history.

A part holds number, mean and squared deviations of one series in one month. Parts are stored, a changed month replaces
its own, and parts of any months merge to the moments of all their days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anaquel.settings import SERIE


def month_moments(fact: DataFrame, column: str = "unidades") -> DataFrame:
    """``tienda_id, sku, mes, n, media, m2`` of a fact, or of the part of it that holds the changed months."""
    value = F.col(column).cast("double")
    return fact.groupBy(*SERIE, F.date_format("fecha", "yyyy-MM").alias("mes")).agg(
        F.count(value).alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("media"),
        (F.count(value) * F.coalesce(F.var_pop(value), F.lit(0.0))).alias("m2"),
    )


def replace_months(stored: DataFrame, changed: DataFrame) -> DataFrame:
    """The stored parts with the changed months' in their place, and new months added."""
    keys = [*SERIE, "mes"]
    return stored.join(changed.select(*keys), keys, "left_anti").select(*stored.columns).unionByName(changed)


def merged(parts: DataFrame, by: list[str] = SERIE) -> DataFrame:
    """``by, n, media, m2`` of all days of the parts.

    The squared deviations are moved to the common mean before they are added, so close means lose no digits; the
    mean is a window over the same keys, and needs no shuffle of its own.
    """
    whole = Window.partitionBy(*by)
    total = F.sum("n").over(whole)
    mean = F.coalesce(F.try_divide(F.sum(F.col("n") * F.col("media")).over(whole), total), F.lit(0.0))
    shifted = F.col("m2") + F.col("n") * F.pow(F.col("media") - F.col("_media"), 2)
    return parts.withColumn("_media", mean).groupBy(*by).agg(
        F.sum("n").alias("n"), F.first("_media").alias("media"), F.sum(shifted).alias("m2")
    )


def dispersion(moments: DataFrame, by: list[str] = SERIE) -> DataFrame:
    """Sample deviation; NULL for fewer than two days."""
    return moments.select(*by, F.sqrt(F.try_divide("m2", F.nullif(F.col("n") - 1, F.lit(0)))).alias("desviacion"))
