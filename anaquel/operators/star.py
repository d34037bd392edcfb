"""Gold layer: dimensions and the dense daily fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.functions.joins import fits, lookup
from anaquel.functions.numeric import rnd
from anaquel.session import series_partitions
from anaquel.settings import SERIE, SERIE_DIA

# Keys of the shorter list that are put together in one array.
CLAVES_POR_BLOQUE = 4096


def dim_product(catalog: DataFrame) -> DataFrame:
    return catalog.select(
        "sku",
        F.col("title").alias("nombre"),
        F.col("category").alias("categoria"),
        F.col("brand").alias("marca"),
        F.col("price").cast("double").alias("precio"),
        F.coalesce("minimumOrderQuantity", F.lit(1)).cast("int").alias("lote_minimo"),
    )


def dim_store(stores: DataFrame) -> DataFrame:
    return stores.select("tienda_id", F.col("nombre").alias("tienda"), "lead_time")


def dim_date(sales: DataFrame, month_factor: DataFrame, weekday_factor: DataFrame) -> DataFrame:
    """Every day from the first to the last sale, with both seasonal factors.

    ``sales`` is any frame with the valid sales' ``fecha``; the daily totals do as well.
    """
    span = sales.agg(F.min("fecha").alias("primera"), F.max("fecha").alias("ultima"))
    days = span.select(F.explode(F.sequence("primera", "ultima")).alias("fecha"))
    return add_factors(days, month_factor, weekday_factor).select(
        "fecha",
        F.month("fecha").alias("mes"),
        F.date_format("fecha", "EEEE").alias("nombre_dia"),
        "indice_ine",
        "factor_dia",
    )


def add_factors(days: DataFrame, month_factor: DataFrame, weekday_factor: DataFrame) -> DataFrame:
    """Add ``indice_ine`` by month and ``factor_dia`` by weekday to a frame of days."""
    by_month = month_factor.select("mes", F.col("factor").alias("indice_ine"))
    by_weekday = weekday_factor.select("dia", F.col("factor").alias("factor_dia"))
    keyed = days.withColumns({"mes": F.month("fecha"), "dia": F.dayofweek("fecha")})
    return keyed.join(by_month, "mes").join(by_weekday, "dia").drop("mes", "dia")


def sales_daily(sales: DataFrame) -> DataFrame:
    """Units and amount per day, store and product."""
    return sales.groupBy("fecha", "tienda_id", "sku").agg(
        F.sum("unidades").alias("unidades"),
        rnd(F.sum("importe"), 2).alias("importe"),
    )


def series_grid(
    calendar: DataFrame, stores: DataFrame, products: DataFrame, days: Column | None = None
) -> DataFrame:
    """Every day of every store and product, placed by (tienda_id, sku).

    The calendar has no gaps, so its first and last day stand for it: only one row per series is
    shuffled, and its days are unfolded in place. ``days`` is an array of some days instead of all.
    """
    if days is None:
        days = F.sequence(calendar.agg(F.min("fecha")).scalar(), calendar.agg(F.max("fecha")).scalar())
    placed = by_series(_all_series(stores, products))
    return placed.select(*SERIE, F.explode(days).alias("fecha"))


def _all_series(stores: DataFrame, products: DataFrame) -> DataFrame:
    """Every store with every product.

    The shorter list is cut into blocks of ``CLAVES_POR_BLOQUE`` keys on average, one array each. Every
    row of the longer list names all blocks, meets them by an equality join, and unfolds their keys.
    """
    counts = [df.agg(F.count("*")).first()[0] for df in (stores, products)]
    short, key, long, other = (stores, "tienda_id", products, "sku")
    if counts[1] < counts[0]:
        short, key, long, other = (products, "sku", stores, "tienda_id")
    n = max(1, -(-min(counts) // CLAVES_POR_BLOQUE))
    blocks = short.groupBy(F.pmod(F.xxhash64(key), F.lit(n)).alias("_bloque")).agg(
        F.collect_list(key).alias("_claves")
    )
    named = long.select(
        other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias("_bloque")
    )
    blocks = F.broadcast(blocks) if fits(short) else blocks
    return named.join(blocks, "_bloque").select(other, F.explode("_claves").alias(key)).select(*SERIE)


def dense_fact(
    calendar: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    daily: DataFrame,
    inventory: DataFrame,
    days: Column | None = None,
) -> DataFrame:
    """One row per day, store and product; days without sales or inventory count as 0 / false.

    All three inputs hold at most one row per series and day by now, so placing them by series
    cannot pile up on a hot key. ``silver.merge_inventory`` leaves the inventory placed already; later
    windows and aggregates by series reuse this placement.
    """
    grid = series_grid(calendar, stores, products, days)
    return (
        grid.join(by_series(daily), SERIE_DIA, "left")
        .join(inventory, SERIE_DIA, "left")
        .select(
            "fecha", "tienda_id", "sku",
            _or_zero("unidades", "bigint"),
            _or_zero("importe", "double"),
            _or_zero("stock", "int"),
            _or_zero("en_camino", "int"),
            F.coalesce("quiebre", F.lit(False)).alias("quiebre"),
        )
    )


def by_series(df: DataFrame) -> DataFrame:
    """Place the rows of one series in one partition."""
    return df.repartition(series_partitions(df.sparkSession), *SERIE)


def grid_check(
    fact: DataFrame, calendar: DataFrame, stores: DataFrame, products: DataFrame
) -> DataFrame:
    """Rows of the fact against days x stores x products."""

    def size(df: DataFrame) -> Column:
        return df.agg(F.count("*")).scalar()

    return (
        fact.agg(F.count("*").alias("filas"))
        .select("filas", (size(calendar) * size(stores) * size(products)).alias("esperadas"))
        .withColumn("cuadra", F.col("filas") == F.col("esperadas"))
    )


def fact_reconciliation(
    sales: DataFrame, fact: DataFrame, stores: DataFrame
) -> DataFrame:
    """Clean sales and their units by whether the fact can hold them, next to the units it holds.

    ``causa`` is 'en hecho', 'sin fecha' for sales without a readable moment, or 'tienda desconocida'.
    """
    known = stores.select("tienda_id").distinct()
    placed = lookup(sales, known, ["tienda_id"], [F.lit(True).alias("_tienda")], how="left")
    cause = (
        F.when(F.col("fecha").isNull(), "sin fecha")
        .when(F.col("_tienda").isNull(), "tienda desconocida")
        .otherwise("en hecho")
    )
    in_fact = F.when(F.col("causa") == "en hecho", fact.agg(F.sum("unidades")).scalar())
    return (
        placed.groupBy(cause.alias("causa"))
        .agg(F.count("*").alias("ventas"), F.sum("unidades").alias("unidades"))
        .withColumn("unidades_hecho", in_fact)
    )


def last_date(calendar: DataFrame) -> Column:
    """The last day of the calendar as a scalar; cheaper than reading it off the dense fact."""
    return calendar.agg(F.max("fecha")).scalar()


def _or_zero(column: str, kind: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast(kind).alias(column)
