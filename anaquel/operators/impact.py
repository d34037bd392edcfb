"""Business impact of stock-outs: unmet units and lost revenue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.functions.joins import lookup
from anaquel.functions.numeric import count_if, rnd


def impact_totals(
    inventory: DataFrame, history: DataFrame, stores: DataFrame, products: DataFrame
) -> DataFrame:
    """One row: span, units demanded, sold and unmet, revenue made and lost, and both per year.

    Revenue made is taken from the raw history, rejected and repeated rows included.
    """
    year = F.try_divide(F.lit(365.0), F.col("dias"))
    made, lost = F.col("venta_realizada_bruta"), F.col("venta_perdida")

    def size(df: DataFrame) -> Column:
        return df.agg(F.count("*")).scalar()

    revenue = history.agg(F.sum(F.col("unidades") * F.col("precio"))).scalar()
    return (
        inventory.agg(
            F.count_distinct("fecha").alias("dias"),
            F.sum("demanda").alias("demandadas"),
            F.sum("vendidas").alias("vendidas"),
            F.sum("no_atendidas").alias("no_atendidas"),
            F.sum("valor_no_atendido").alias("venta_perdida"),
        )
        .withColumn("venta_realizada_bruta", revenue)
        .select(
            "dias",
            size(stores).alias("tiendas"),
            size(products).alias("productos"),
            "demandadas", "vendidas", "no_atendidas",
            rnd(F.try_divide(F.col("no_atendidas") * 100, F.col("demandadas")), 2)
            .alias("pct_no_atendido"),
            rnd(made, 2).alias("venta_realizada_bruta"),
            rnd(lost, 2).alias("venta_perdida"),
            rnd(F.try_divide(lost * 100, made), 2).alias("perdida_pct"),
            rnd(year, 2).alias("factor_anual"),
            rnd(made * year, 2).alias("venta_realizada_anual"),
            rnd(lost * year, 2).alias("venta_perdida_anual"),
        )
    )


def lost_by_store(inventory: DataFrame, stores: DataFrame) -> DataFrame:
    """Lost revenue per store with its lead time; a store without rows shows 0."""
    lost = inventory.groupBy("tienda_id").agg(F.sum("valor_no_atendido").alias("_perdida"))
    return stores.select("tienda_id", "lead_time").join(lost, "tienda_id", "left").select(
        "tienda_id", "lead_time", F.coalesce(rnd("_perdida", 2), F.lit(0.0)).alias("venta_perdida")
    )


def lost_by_category(inventory: DataFrame, catalog: DataFrame, top: int = 5) -> DataFrame:
    """The categories that lose most; products outside the catalogue do not count.

    Reduced to one row per product before the category is looked up.
    """
    per_product = inventory.groupBy("sku").agg(F.sum("valor_no_atendido").alias("_perdida"))
    return (
        lookup(per_product, catalog, ["sku"], ["category"])
        .groupBy("category")
        .agg(rnd(F.sum("_perdida"), 2).alias("venta_perdida"))
        .orderBy(F.desc("venta_perdida"), "category")
        .limit(top)
    )


def stockout_rate(inventory: DataFrame) -> DataFrame:
    """Observations without stock and their share in percent."""
    return inventory.agg(
        count_if(F.col("quiebre")).alias("en_quiebre"), F.count("*").alias("observaciones")
    ).withColumn(
        "tasa_quiebre_pct", rnd(F.try_divide(F.col("en_quiebre") * 100, F.col("observaciones")), 2)
    )
