"""The full batch cycle: bronze inputs to gold tables, model, KPIs and export.

A cycle recomputes everything from its inputs, so running it again gives the same tables. It writes a
version of its own and publishes it at its end: readers of earlier versions go on, and a cycle that dies changes
nothing (``anaquel.sources.snapshots``). Five tables are stored on the way and read back; each later step
starts from files, not from the whole lineage. An outside schedule calls the cycle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.operators import (
    features,
    forecast,
    impact,
    model,
    risk,
    season,
    serving,
    silver,
    star,
)
from anaquel import schemas
from anaquel.session import configure, series_partitions, size_series, stage
from anaquel.settings import Params
from anaquel.sources import readers, snapshots, writers
from anaquel.sources.literals import local_frame


@dataclass(frozen=True)
class Inputs:
    catalog: DataFrame
    stores: DataFrame
    month_factor: DataFrame
    weekday_factor: DataFrame
    history: DataFrame
    landed: DataFrame
    inventory_history: DataFrame
    inventory_live: DataFrame


def read_bronze(spark: SparkSession, root: str, stream_format: str = "parquet") -> Inputs:
    """The inputs of a cycle from a bronze folder; the live feeds may be absent."""
    configure(spark)
    return Inputs(
        catalog=readers.read_catalog(spark, f"{root}/catalogo.json"),
        stores=readers.stores(spark),
        month_factor=readers.read_month_factors(spark, f"{root}/factores_mes.json"),
        weekday_factor=readers.weekday_factors(spark),
        history=readers.read_sales_history(spark, f"{root}/ventas_historico.csv"),
        landed=readers.read_stream_landed(spark, f"{root}/ventas_stream", stream_format),
        inventory_history=readers.read_inventory_history(spark, f"{root}/inventario.csv"),
        inventory_live=readers.read_inventory_live(spark, f"{root}/inventario_hoy.csv"),
    )


def run_cycle(
    spark: SparkSession,
    inputs: Inputs,
    out: str,
    params: Params = Params(),
    as_of: Column | None = None,
) -> dict[str, DataFrame]:
    """Build and store every table as a new version below ``out``; return readers of them by table name.

    The version also holds the model (``modelo``, if there is one) and the export (``alertas``). Readers of
    other sessions open it with ``snapshots.latest``.
    """
    configure(spark)
    now = F.current_timestamp() if as_of is None else as_of
    draft = snapshots.begin(spark, out)
    tables: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame, layer: str = "oro") -> DataFrame:
        tables[name] = draft.save(name, df, layer)
        return tables[name]

    def keep_by_series(name: str, df: DataFrame, layer: str = "oro") -> DataFrame:
        tables[name] = draft.save_by_series(name, df, series_partitions(spark), layer)
        return tables[name]

    # Silver. The raw texts are parsed once: all else reads columns of the reviewed rows.
    products = keep("dim_producto", star.dim_product(inputs.catalog))
    reviewed = keep(
        "revisadas",
        silver.review_sales(silver.unify_sales(inputs.history, inputs.landed), products),
        "plata",
    )
    sales = keep("ventas", silver.clean_sales(reviewed), "plata")
    counts = keep("revision", silver.review_counts(reviewed), "plata")
    keep("rechazos", silver.rejects_from_counts(counts))
    quality = keep("calidad", silver.quality_from_layers(counts, sales))
    keep("frescura", silver.freshness_from_days(counts, now))

    # Star schema
    stores = keep("dim_tienda", star.dim_store(inputs.stores))
    calendar = keep(
        "dim_tiempo", star.dim_date(sales, inputs.month_factor, inputs.weekday_factor)
    )
    size_series(spark, calendar.count(), stores.count(), products.count())
    inventory = silver.merge_inventory(inputs.inventory_history, inputs.inventory_live)
    fact = keep_by_series(
        "hecho_ventas",
        star.dense_fact(calendar, stores, products, star.sales_daily(sales), inventory),
    )
    keep("control_malla", star.grid_check(fact, calendar, stores, products))
    keep("conciliacion", star.fact_reconciliation(sales, fact, stores))

    # Forecast
    daily = keep_by_series(
        "pronostico", forecast.forecast_daily(forecast.deseasonalised(fact, calendar))
    )
    keep("metricas_pronostico", forecast.backtest(daily, calendar, params.dias_test))
    future = forecast.future_calendar(
        calendar, inputs.month_factor, inputs.weekday_factor, max(params.horizontes)
    )
    horizon = keep(
        "prevision", forecast.forecast_horizon(forecast.current_level(daily, calendar), future)
    )

    # Classifier
    rows = keep_by_series(
        "variables", features.feature_rows(fact, products, stores, params), "plata"
    )
    trained = model.train(rows, params)
    if trained is None:  # the version has no model then, whatever earlier ones had
        keep("metricas_modelo", local_frame(spark, [], schemas.METRICAS))
        keep("importancia", local_frame(spark, [], schemas.IMPORTANCIA))
        probability = keep("probabilidad", model.no_probability(spark))
    else:
        keep("metricas_modelo", trained.metrics)
        keep("importancia", trained.importance)
        writers.save_model(trained.model, draft.path("modelo", "modelo"))
        probability = keep(
            "probabilidad", model.score(trained.model, rows, star.last_date(calendar))
        )

    # Risk, KPIs, export
    situation = risk.current_situation(fact, calendar, stores, products, params)
    alerts = risk.alerts(situation, horizon, probability, params)
    tables["hecho_riesgo"] = draft.save_partitioned(
        "hecho_riesgo", risk.risk_fact(alerts, products), "horizonte"
    )
    keep("kpis", serving.kpis(calendar, quality, tables["hecho_riesgo"], fact, sales, now))
    writers.export_csv(serving.open_alerts(tables["hecho_riesgo"]), draft.path("alertas", "salida"))
    draft.commit()
    return tables


def refresh_seasonality(spark: SparkSession, root: str, as_of: Column | None = None) -> DataFrame:
    """Month factors from the bronze index series, saved as a JSON map, with a manifest entry."""
    configure(spark)
    series = readers.read_index_series(spark, f"{root}/ine.json")
    entries = F.collect_list(F.struct(F.col("mes").cast("string"), "factor"))
    path = f"{root}/factores_mes.json"
    season.seasonal_index(series).agg(
        F.to_json(F.map_from_entries(entries)).alias("value")
    ).write.mode("overwrite").text(path)
    log_load(series, root, "ine.json", "indice estacional", as_of)
    return readers.read_month_factors(spark, path)


def log_load(
    rows: DataFrame, root: str, fichero: str, origen: str, as_of: Column | None = None
) -> None:
    """Append an accepted load and its number of rows to the manifest of a bronze folder."""
    now = F.current_timestamp() if as_of is None else as_of
    writers.append_manifest(
        rows.agg(F.count("*").alias("registros")).select(
            F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("fecha"),
            F.lit(origen).alias("origen"),
            F.lit(fichero).alias("fichero"),
            "registros",
        ),
        f"{root}/_manifiesto",
    )


def load_snapshot(
    rows: DataFrame, root: str, fichero: str, origen: str, as_of: Column | None = None
) -> DataFrame:
    """Accept a load: its rows as a JSON snapshot in the bronze folder, with a manifest row.

    Returns the snapshot, read back.
    """
    path = f"{root}/{fichero}"
    writers.save_json(rows, path)
    snapshot = rows.sparkSession.read.schema(rows.schema).json(path)
    log_load(snapshot, root, fichero, origen, as_of)
    return snapshot


def accept_inputs(
    inputs: Inputs, index_series: DataFrame, root: str, as_of: Column | None = None
) -> dict[str, DataFrame]:
    """Snapshots and manifest rows of catalogue, index series, month factors and stores."""
    loads = {
        "catalogo": (inputs.catalog, "catalogo de productos"),
        "indice": (index_series, "indice estacional"),
        "factores": (inputs.month_factor, "factores de mes"),
        "tiendas": (inputs.stores, "tiendas"),
    }
    return {
        name: load_snapshot(rows, root, f"instantanea/{name}", origen, as_of)
        for name, (rows, origen) in loads.items()
    }


def impact_report(inputs: Inputs) -> dict[str, DataFrame]:
    """The business-impact summary over the inventory history and the raw sales history.

    The inventory text is parsed once and stored; the four reports read columns of that table.
    """
    inventory = stage(inputs.inventory_history, "inventario")
    return {
        "totales": impact.impact_totals(
            inventory, inputs.history, inputs.stores, inputs.catalog
        ),
        "perdida_por_tienda": impact.lost_by_store(inventory, inputs.stores),
        "perdida_por_categoria": impact.lost_by_category(inventory, inputs.catalog),
        "quiebres": impact.stockout_rate(inventory),
    }
