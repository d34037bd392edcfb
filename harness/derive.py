"""Retail inputs derived by Spark from the given tables.

The tables hold no point-of-sale feed, so order lines play sales, part brands play products and
regions play stores. The ``%`` rules below plant the defects a real feed has (missing ids, unknown
products, bad units and prices); they keep every row. ``harness.oracle`` states the same rules in SQL.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anaquel import schemas
from anaquel.functions.joins import lookup
from anaquel.functions.numeric import rnd
from anaquel.operators import features, forecast, model, moments, risk, runs, season, silver, star, trees
from anaquel.plans import incremental
from anaquel.session import (
    configure,
    scratch_generation,
    scratch_path,
    size_series,
    stage,
    stage_by_series,
)
from anaquel.settings import SERIE, SERIE_DIA
from anaquel.sources import readers, snapshots

AS_OF = "2001-12-01 00:00:00"


class Domain:
    """Lazy frames over one folder of test tables.

    What a cycle finds as files or stores between its layers is stored here as well, on first use:
    catalogue, month factors, inventory; clean sales, daily totals, calendar, dense fact, features. All else is
    recomputed by each query.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def as_of(self) -> Column:
        return F.lit(AS_OF).cast("timestamp")

    # --- Inputs -----------------------------------------------------------

    def _lines(self, status: str) -> DataFrame:
        """Order lines of one status as sales; lines move for a dimension only if that is too large to be broadcast."""
        key = F.col("l_orderkey")
        lines = self.table("lineitem").where(F.col("l_linestatus") == status)
        lines = lookup(lines, self._regions, ["l_suppkey"], ["n_regionkey"])
        lines = lookup(lines, self._parts, ["l_partkey"], ["p_brand", "p_retailprice"])
        units = (
            F.when(key % 100 == 7, 0).when(key % 100 == 8, -1).otherwise(F.col("l_quantity"))
        )
        moment = F.col("l_shipdate").cast("timestamp")
        return lines.select(
            F.when(key % 500 != 13, F.concat(key, F.lit("-"), "l_linenumber")).alias("venta_id"),
            moment.alias("momento"),
            F.concat(F.lit("T0"), F.col("n_regionkey") + 1).alias("tienda_id"),
            F.when(key % 200 == 11, F.concat(F.lit("SIN-CATALOGAR-"), key % 999))
            .otherwise(F.col("p_brand"))
            .alias("sku"),
            units.cast("int").alias("unidades"),
            F.when(key % 97 == 3, 0.0).otherwise(F.col("p_retailprice")).alias("precio"),
            rnd(F.col("p_retailprice") * F.col("l_quantity"), 2).alias("importe"),
            (key % 3).cast("int").alias("particion"),
            (key * 10 + F.col("l_linenumber")).alias("offset_kafka"),
            F.timestamp_add("SECOND", (key % 120).cast("int"), moment).alias("recibido"),
        )

    @cached_property
    def _regions(self) -> DataFrame:
        nation = F.broadcast(self.table("nation").select("n_nationkey", "n_regionkey"))
        suppliers = self.table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        return suppliers.select(F.col("s_suppkey").alias("l_suppkey"), "n_regionkey")

    @cached_property
    def _parts(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice")

    @cached_property
    def history(self) -> DataFrame:
        return self._lines("F").select(schemas.VENTA.fieldNames())

    @cached_property
    def landed(self) -> DataFrame:
        return self._lines("O").select(schemas.VENTA_STREAM.fieldNames())

    @cached_property
    def feeds(self) -> tuple[DataFrame, DataFrame]:
        """History and landed sales, stored, for what reads them more than once."""
        return stage(self.history, "historico"), stage(self.landed, "flujo")

    @cached_property
    def catalog(self) -> DataFrame:
        number = F.substring_index("p_brand", "#", -1).cast("int")
        products = (
            self.table("part")
            .groupBy("p_brand")
            .agg(rnd(F.avg("p_retailprice"), 2).alias("price"), F.count("*").alias("n"))
            .select(
                number.alias("id"),
                F.col("p_brand").alias("title"),
                F.col("p_brand").alias("sku"),
                F.concat(F.lit("C"), number % 6).alias("category"),
                F.when(number % 3 != 0, F.col("p_brand")).alias("brand"),
                "price",
                F.col("n").cast("int").alias("stock"),
                F.when(number % 5 != 0, number % 4 + 1).alias("minimumOrderQuantity"),
            )
        )
        return stage(products, "catalogo")

    @cached_property
    def stores(self) -> DataFrame:
        return readers.stores(self.spark)

    @cached_property
    def index_series(self) -> DataFrame:
        """Order value per month; the running month is not published yet."""
        orders = self.table("orders").select(
            F.trunc("o_orderdate", "month").alias("_mes"), "o_totalprice"
        )
        running = orders.agg(F.max("_mes")).scalar()
        return (
            orders.groupBy("_mes")
            .agg(rnd(F.sum("o_totalprice"), 2).alias("total"))
            .select(
                F.month("_mes").alias("FK_Periodo"),
                F.when(F.col("_mes") < running, F.col("total")).alias("Valor"),
            )
        )

    @cached_property
    def inventory_history(self) -> DataFrame:
        """Daily stock under an order-up-to rule with the store's lead time."""
        stores = F.broadcast(self.stores.select("tienda_id", "lead_time"))
        prices = self.catalog.select("sku", "price")
        grid = star.series_grid(self.calendar, self.stores, self.catalog)
        daily = star.by_series(self.daily.select(*SERIE_DIA, "unidades"))
        units = (
            grid.join(daily, SERIE_DIA, "left")
            .join(stores, "tienda_id")
            .withColumn("u", F.coalesce("unidades", F.lit(0)))
        )
        series = Window.partitionBy(*SERIE)
        by_day = series.orderBy("fecha")
        arriving = F.lit(None).cast("bigint")
        for lead in (2, 3, 4, 5):
            window = by_day.rowsBetween(-(lead - 1), 0)
            arriving = F.when(F.col("lead_time") == lead, F.sum("u").over(window)).otherwise(arriving)
        target = F.ceil(
            rnd(
                F.avg("u").over(series) * F.col("lead_time")
                + F.coalesce(F.stddev_samp("u").over(series), F.lit(0.0)) * F.sqrt("lead_time"),
                6,
            )
        )
        free = F.col("objetivo") - F.col("en_camino")
        unmet = F.least(F.col("u"), F.greatest(-free, F.lit(0)))
        rows = (
            units.withColumns({"objetivo": target, "en_camino": arriving})
            .withColumns({
                "stock": F.greatest(free, F.lit(0)), "quiebre": free <= 0, "no_atendidas": unmet
            })
            .join(prices, "sku")
            .withColumns({
                "demanda": F.col("u"),
                "vendidas": F.col("u") - F.col("no_atendidas"),
                "valor_no_atendido": rnd(F.col("no_atendidas") * F.col("price"), 2),
            })
        )
        typed = (F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.INVENTARIO.fields)
        return stage_by_series(rows.select(*typed), "inventario")

    @cached_property
    def inventory_live(self) -> DataFrame:
        """The last day counted again: one unit more on every shelf."""
        last = self.inventory_history.where(F.col("fecha") == star.last_date(self.calendar))
        return last.withColumns({"stock": F.col("stock") + 1, "quiebre": F.lit(False)})

    # --- Silver -----------------------------------------------------------

    @cached_property
    def raw(self) -> DataFrame:
        return silver.unify_sales(self.history, self.landed)

    @cached_property
    def reviewed(self) -> DataFrame:
        return silver.review_sales(self.raw, self.catalog)

    @cached_property
    def sales(self) -> DataFrame:
        """Clean sales, stored."""
        return stage(silver.clean_sales(self.reviewed), "ventas")

    # --- Gold -------------------------------------------------------------

    @cached_property
    def month_factor(self) -> DataFrame:
        return stage(season.seasonal_index(self.index_series), "factores_mes")

    @cached_property
    def weekday_factor(self) -> DataFrame:
        return readers.weekday_factors(self.spark)

    @cached_property
    def products(self) -> DataFrame:
        return star.dim_product(self.catalog)

    @cached_property
    def store_dim(self) -> DataFrame:
        return star.dim_store(self.stores)

    @cached_property
    def calendar(self) -> DataFrame:
        """Days with factors, stored."""
        days = stage(self.dates(self.daily), "dim_tiempo")
        size_series(self.spark, days.count(), self.stores.count(), self.catalog.count())
        return days

    def dates(self, sales: DataFrame) -> DataFrame:
        return star.dim_date(sales, self.month_factor, self.weekday_factor)

    @cached_property
    def daily(self) -> DataFrame:
        """Daily totals, stored; the clean sales are stored only where something else reads them."""
        if "sales" in self.__dict__:
            return stage(star.sales_daily(self.sales), "ventas_dia")
        raw = silver.unify_sales(*self.feeds) if "feeds" in self.__dict__ else self.raw
        sales = silver.clean_sales(silver.review_sales(raw, self.catalog))
        return stage(star.sales_daily(sales), "ventas_dia")

    @cached_property
    def inventory(self) -> DataFrame:
        return silver.merge_inventory(self.inventory_history, self.inventory_live, placed=True)

    @cached_property
    def runs(self) -> DataFrame:
        """The fact as runs, stored."""
        return stage(
            runs.fact_runs(self.calendar, self.stores, self.catalog, self.daily, self.inventory), "tramos"
        )

    @cached_property
    def moments(self) -> DataFrame:
        """Moments by month of the first half of the fact, with those of the rest put in afterwards, stored."""
        middle = self.calendar.agg(F.date_add(F.min("fecha"), F.floor(F.count("*") / 2).cast("int"))).scalar()
        early = stage(moments.month_moments(self.fact.where(F.col("fecha") <= middle)), "momentos_antes")
        month = F.trunc(middle, "month")
        late = moments.month_moments(self.fact.where(F.col("fecha") >= month))
        return stage(moments.replace_months(early, late), "momentos")

    @cached_property
    def refreshed(self) -> snapshots.Version:
        """Daily tables built from what landed until 30 days before the end, then refreshed with the rest.

        One order in 331 lands late, whenever it was made: it changes days long past.
        """
        fixed = incremental.Fixed(self.catalog, self.stores, self.month_factor, self.weekday_factor)
        history, feed = self.feeds
        end = feed.agg(F.max("recibido")).first()[0]
        cut = F.lit(end - dt.timedelta(days=30))
        late = F.floor(F.col("offset_kafka") / 10) % 331 == 5
        arrival = F.when(late, F.greatest("recibido", cut + F.expr("INTERVAL 1 DAY"))).otherwise(F.col("recibido"))
        early = F.coalesce(arrival <= cut, F.lit(False))
        rest = feed.where(~early)

        def inventory(sales: DataFrame) -> DataFrame:
            """From all sales: the build's, whose arrival is as it was, and the rest of the feed."""
            if "daily" not in self.__dict__:
                everything = incremental.with_landed(sales, rest, self.products)
                self.daily = stage(star.sales_daily(everything), "ventas_dia")
            return stage(self.inventory, "inventario_unico")

        out = scratch_path(self.spark, "diario")
        incremental.build(self.spark, out, fixed, history, feed.where(early), inventory)
        return incremental.refresh(self.spark, out, fixed, feed.withColumn("recibido", arrival))

    @cached_property
    def stumps(self) -> DataFrame:
        """Trees of one split, from the training rows, stored."""
        cut = features.split_summary(self.features).select("corte").scalar()
        return stage(trees.stump_nodes(features.split(self.features, cut)[0]), "tocones")

    def stump_scores(self, rows: DataFrame) -> DataFrame:
        return trees.score_nodes(rows, self.stumps, trees.vector_of(), depth=1)

    @cached_property
    def fact_query(self) -> DataFrame:
        return star.dense_fact(
            self.calendar, self.stores, self.catalog, self.daily, self.inventory
        )

    @cached_property
    def fact(self) -> DataFrame:
        """The dense fact, stored."""
        return stage_by_series(self.fact_query, "hecho_ventas")

    # --- Forecast, classifier, risk ---------------------------------------

    @cached_property
    def forecast(self) -> DataFrame:
        return forecast.forecast_daily(forecast.deseasonalised(self.fact, self.calendar))

    @cached_property
    def backtest(self) -> DataFrame:
        return forecast.backtest(self.forecast, self.calendar)

    @cached_property
    def future(self) -> DataFrame:
        return forecast.future_calendar(self.calendar, self.month_factor, self.weekday_factor, 14)

    @cached_property
    def horizon(self) -> DataFrame:
        return forecast.forecast_horizon(
            forecast.current_level(self.forecast, self.calendar), self.future
        )

    @cached_property
    def feature_query(self) -> DataFrame:
        return features.feature_rows(self.fact, self.products, self.store_dim)

    @cached_property
    def features(self) -> DataFrame:
        """Feature rows, stored."""
        return stage_by_series(self.feature_query, "variables")

    @cached_property
    def test_rows(self) -> DataFrame:
        cut = features.split_summary(self.features).select("corte").scalar()
        return features.split(self.features, cut)[1]

    @cached_property
    def trained(self) -> model.Trained | None:
        return model.train(self.features)

    @cached_property
    def probability(self) -> DataFrame:
        if self.trained is None:
            return model.no_probability(self.spark)
        return model.score(self.trained.model, self.features, star.last_date(self.calendar))

    @cached_property
    def situation(self) -> DataFrame:
        return risk.current_situation(self.fact, self.calendar, self.store_dim, self.products)

    def risk(self, probability: DataFrame | None = None) -> DataFrame:
        chance = model.no_probability(self.spark) if probability is None else probability
        return risk.risk_fact(risk.alerts(self.situation, self.horizon, chance), self.products)


_domains: dict[tuple[str, int, str], Domain] = {}


def domain(spark: SparkSession, sf_dir: str) -> Domain:
    """The domain of one folder in one Spark application, as long as its stored frames are there."""
    key = (spark.sparkContext.applicationId, scratch_generation(spark), sf_dir)
    if key not in _domains:
        _domains[key] = Domain(spark, sf_dir)
    return _domains[key]
