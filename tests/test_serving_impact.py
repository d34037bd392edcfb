from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from anaquel import schemas
from anaquel.operators import impact, model, serving, silver
from tests.conftest import day, moment, rows


@pytest.fixture
def risk_rows(spark):
    def alert(store, sku, horizon, level, priority, value):
        return (store, f"n{store}", sku, f"p{sku}", level, 1.0, 0.0, 2.0, -1.0, 0.5, 0.0, 3, value,
                priority, horizon)

    return spark.createDataFrame(
        [
            alert("T02", "A", 7, "ALTO", 500.0, 10.0),
            alert("T01", "A", 7, "CRITICO", 1000.0, 20.0),
            alert("T01", "B", 7, "CRITICO", 1045.0, 5.5),
            alert("T02", "B", 7, "OK", 0.0, 0.0),
            alert("T02", "C", 7, "CRITICO", 1000.0, 1.0),
            alert("T01", "A", 14, "MEDIO", 100.0, 7.0),
        ],
        "tienda_id string, tienda string, sku string, producto string, nivel string, "
        "stock double, en_camino double, demanda_prevista double, proyectado double, "
        "stock_seguridad double, probabilidad double, cantidad_sugerida long, "
        "valor_en_riesgo double, prioridad double, horizonte int",
    )


def test_search_orders_by_priority_then_store_and_product(risk_rows):
    found = serving.search_alerts(risk_rows)
    assert rows(found, "tienda", "sku") == [
        ("nT01", "B"), ("nT01", "A"), ("nT02", "C"), ("nT02", "A"),
    ]
    assert rows(serving.search_alerts(risk_rows, limite=1), "sku") == [("B",)]
    assert rows(serving.search_alerts(risk_rows, nivel="OK"), "sku") == [("B",)]
    assert rows(serving.search_alerts(risk_rows, "CRITICO", "T02"), "sku") == [("C",)]
    assert serving.search_alerts(risk_rows, horizonte=14).count() == 1
    assert serving.search_alerts(risk_rows, horizonte=5).count() == 0


@pytest.mark.parametrize("bad", [{"horizonte": 0}, {"horizonte": 15}, {"limite": 0}, {"limite": 501}])
def test_search_checks_its_arguments(risk_rows, bad):
    with pytest.raises(ValueError):
        serving.search_alerts(risk_rows, **bad)


def test_filter_values_are_never_sql(risk_rows):
    assert serving.search_alerts(risk_rows, nivel="x' OR '1'='1").count() == 0


def test_search_is_a_top_k_on_one_partition(spark, risk_rows, tmp_path):
    from anaquel.sources import writers

    stored = writers.save_partitioned(risk_rows, str(tmp_path / "riesgo"))
    plan = serving.search_alerts(stored)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "PartitionFilters: [isnotnull(horizonte" in plan


def test_panel_and_counts(risk_rows):
    assert serving.panel_alerts(risk_rows).count() == 4
    assert serving.panel_alerts(risk_rows, "ALTO").count() == 1
    counts = serving.alerts_by_store_level(risk_rows)
    assert sorted(rows(counts)) == [("nT01", "CRITICO", 2), ("nT02", "ALTO", 1), ("nT02", "CRITICO", 1)]
    assert rows(serving.alerts_by_store_level(risk_rows, "ALTO")) == [("nT02", "ALTO", 1)]


def test_counts_go_beyond_the_panel_list(risk_rows):
    one = risk_rows.where("nivel = 'ALTO' AND horizonte = 7").limit(1)
    many = one.crossJoin(one.sparkSession.range(400)).drop("id")
    assert serving.panel_alerts(many).count() == 300
    assert [r.alertas for r in serving.alerts_by_store_level(many).collect()] == [400]


def test_model_report_holds_all_parts(spark):
    rule = spark.createDataFrame([(1, 2, 3, 0.5, 0.25)], "vp_regla long, fp_regla long, fn_regla long, p double, r double")
    back = spark.createDataFrame([(10, 1.5)], "observaciones long, mae_base double")
    balance = spark.createDataFrame([(2.0,)], "peso_positivos double")
    metrics = spark.createDataFrame([(0.9, 5)], "auc double, vp long")
    weights = spark.createDataFrame([("stock", 0.7)], "variable string, importancia double")
    fixed = rows(serving.model_report(rule, back, balance))
    assert ("pronostico", "mae_base", 1.5) in fixed and ("clases", "peso_positivos", 2.0) in fixed
    full = rows(serving.model_report(rule, back, balance, metrics, weights))
    assert set(full) - set(fixed) == {("modelo", "auc", 0.9), ("modelo", "vp", 5.0), ("importancia", "stock", 0.7)}


def test_export_keeps_all_open_alerts_in_order(risk_rows):
    export = serving.open_alerts(risk_rows)
    assert rows(export, "sku", "nivel") == [
        ("B", "CRITICO"), ("A", "CRITICO"), ("C", "CRITICO"), ("A", "ALTO"),
    ]
    assert len(export.columns) == 10


def test_kpi_risk(risk_rows):
    assert tuple(serving.kpi_risk(risk_rows).first()) == (3, 1, 0, 36.5)
    assert tuple(serving.kpi_risk(risk_rows.where("1 = 0")).first()) == (0, 0, 0, None)


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [(day(n), n in (1, 9)) for n in range(1, 11)], "fecha date, quiebre boolean"
    )


def test_kpi_stockout_rate_covers_the_last_week(fact):
    assert serving.kpi_stockout_rate(fact, fact.select("fecha")).first()[0] == 14.29


@pytest.fixture
def sales(spark):
    def sale(origen, n, delay):
        at = moment(n)
        return (origen, at, at + dt.timedelta(seconds=delay) if delay is not None else None)

    return spark.createDataFrame(
        [sale("historico", 9, None), sale("streaming", 1, 10), sale("streaming", 2, 15)],
        "origen string, momento timestamp, recibido timestamp",
    )


def test_kpi_streaming(sales):
    as_of = F.lit(moment(2) + dt.timedelta(seconds=90))
    assert tuple(serving.kpi_streaming(sales, as_of).first()) == (2, 12.5, 90, 1.5)
    nothing = serving.kpi_streaming(sales.where("origen = 'historico'"), as_of).first()
    assert tuple(nothing) == (0, 0.0, 0, 0.0)


def test_kpi_row(spark, fact, risk_rows, sales):
    quality = spark.createDataFrame([(98.5,)], "calidad_pct double")
    as_of = F.lit(moment(2))
    got = serving.kpis(fact.select("fecha"), quality, risk_rows, fact, sales, as_of).first()
    assert tuple(got) == (day(10), 98.5, 3, 1, 0, 36.5, 14.29, 2, 12.5, 0)


def test_ranked_lists(spark):
    rejects = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "motivo_rechazo string, registros long")
    assert rows(serving.ranked_rejects(rejects), "motivo_rechazo") == [("b",), ("c",), ("a",)]
    weights = spark.createDataFrame([("x", 0.1), ("y", 0.9)], "variable string, importancia double")
    assert rows(serving.ranked_importance(weights), "variable") == [("y",), ("x",)]


def test_model_against_rule(spark):
    metrics = spark.createDataFrame(
        [(0.5, 0.8, 0.6, 0.7)],
        "precision double, recall double, precision_regla double, recall_regla double",
    )
    assert tuple(model.model_vs_rule(metrics).first()) == (0.8, 0.1, 0.5, -0.1)


@pytest.fixture
def inventory(spark):
    def row(n, store, sku, asked, missed, value, out):
        return (day(n), store, sku, 0, 0, out, asked, asked - missed, missed, value)

    return spark.createDataFrame(
        [
            row(1, "T01", "A", 10, 4, 8.0, True),
            row(2, "T01", "B", 5, 0, 0.0, False),
            row(2, "T01", "X", 5, 1, 100.0, True),
        ],
        schemas.INVENTARIO,
    )


def test_impact_totals_use_the_raw_history(spark, inventory, two_stores, catalog):
    history = spark.createDataFrame(
        [
            ("a", moment(1), "T01", "A", 10, 2.0, 0.0),
            ("a", moment(1), "T01", "A", 10, 2.0, 0.0),
            (None, moment(1), "T01", "X", -1, 5.0, 0.0),
            ("b", moment(1), "T01", "A", None, 5.0, 0.0),
        ],
        schemas.VENTA,
    )
    got = impact.impact_totals(inventory, history, two_stores, catalog).first().asDict()
    assert got == {
        "dias": 2, "tiendas": 2, "productos": 2,
        "demandadas": 20, "vendidas": 15, "no_atendidas": 5, "pct_no_atendido": 25.0,
        "venta_realizada_bruta": 35.0, "venta_perdida": 108.0, "perdida_pct": 308.57,
        "factor_anual": 182.5, "venta_realizada_anual": 6387.5, "venta_perdida_anual": 19710.0,
    }


def test_lost_by_store_shows_stores_without_rows(inventory, two_stores):
    got = impact.lost_by_store(inventory, two_stores).orderBy("tienda_id")
    assert rows(got) == [("T01", 2, 108.0), ("T02", 4, 0.0)]


def test_lost_by_category_ignores_unknown_products(inventory, catalog):
    assert rows(impact.lost_by_category(inventory, catalog)) == [("comida", 8.0), ("bebida", 0.0)]
    assert rows(impact.lost_by_category(inventory, catalog, top=1)) == [("comida", 8.0)]


def test_stockout_rate(inventory):
    assert tuple(impact.stockout_rate(inventory).first()) == (2, 3, 66.67)
    assert impact.stockout_rate(inventory.where("1 = 0")).first().tasa_quiebre_pct is None


def test_rejects_feed_the_quality_page(spark, catalog):
    raw = silver.unify_sales(
        spark.createDataFrame([("a", moment(1), "T01", "X", 1, 1.0, 1.0)], schemas.VENTA),
        spark.createDataFrame([], schemas.VENTA_STREAM),
    )
    ranked = serving.ranked_rejects(silver.rejects_by_reason(silver.review_sales(raw, catalog)))
    assert rows(ranked) == [("sku no catalogado", 1)]
