"""Rank statistics of scored rows without sorting them all in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.session import stage

TRAMOS = 64  # ranges of scores that are ranked by themselves
_EXACTO = "decimal(38,0)"


def exact_auc(scored: DataFrame, score: Column, label: Column) -> DataFrame:
    """One row ``auc, positivos, negativos``: the share of pairs of classes that the score orders rightly.

    Equal scores count half, and nothing is binned: rows are first summed up by score, and a score's rank is the
    negatives of all lower ranges of scores plus those of lower scores in its own range. Ranges are cut at
    quantiles, so that each holds about as many different scores. Rows without label or score are left out; without
    both classes the statistic is NULL.
    """
    rows = scored.select(score.cast("double").alias("s"), label.cast("int").alias("y"))
    per_score = stage(
        rows.where("y IS NOT NULL AND s IS NOT NULL").groupBy("s").agg(
            F.count(F.when(F.col("y") == 1, True)).alias("p"), F.count(F.when(F.col("y") == 0, True)).alias("n")
        ), "por_puntuacion",
    )
    cuts = per_score.agg(F.percentile_approx("s", [i / TRAMOS for i in range(1, TRAMOS)], 10_000)).first()[0] or []
    above = sum(((F.col("s") > cut).cast("int") for cut in sorted(set(cuts))), F.lit(0))
    ranged = per_score.withColumn("tramo", above)
    # One row per range.
    lower = ranged.groupBy("tramo").agg(F.sum("n").alias("n")).select(
        "tramo", (F.sum("n").over(Window.orderBy("tramo")) - F.col("n")).alias("antes")
    )
    within = Window.partitionBy("tramo").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("debajo", F.coalesce(F.sum("n").over(within), F.lit(0))).join(
        F.broadcast(lower), "tramo"
    )
    twice = (2 * (F.col("antes") + F.col("debajo")) + F.col("n")).cast(_EXACTO) * F.col("p").cast("decimal(19,0)")
    sums = ranked.agg(
        F.sum(twice.cast(_EXACTO)).cast("double").alias("pares"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("positivos"), F.coalesce(F.sum("n"), F.lit(0)).alias("negativos"),
    )
    both = F.col("positivos").cast("double") * F.col("negativos")
    return sums.select(F.try_divide("pares", 2 * both).alias("auc"), "positivos", "negativos")
