"""Seasonal index from a monthly series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.functions.numeric import rnd


def seasonal_index(observations: DataFrame) -> DataFrame:
    """Factor per month 1..12: its mean over the mean of the monthly means; 1.0 without data.

    The observations are reduced to at most 12 rows first; all that follows is tiny.
    """
    monthly = (
        observations.where(F.col("Valor").isNotNull() & F.col("FK_Periodo").between(1, 12))
        .groupBy(F.col("FK_Periodo").alias("mes"))
        .agg(F.avg("Valor").alias("media"))
    )
    general = monthly.agg(F.avg("media")).scalar()
    months = observations.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("mes"))
    return (
        months.join(monthly, "mes", "left")
        .withColumn("general", general)
        .select("mes", rnd(F.try_divide(F.coalesce("media", "general"), "general"), 4).alias("factor"))
    )
