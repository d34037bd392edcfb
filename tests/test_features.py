from __future__ import annotations

import statistics

import pytest

from anaquel.operators import features, star
from anaquel.settings import Params
from tests.conftest import day, rows

UNITS = [(n * 7) % 11 for n in range(1, 41)]


@pytest.fixture
def fact(spark):
    # 40 days of one series; empty shelves on days 10 and 40.
    return spark.createDataFrame(
        [
            (day(n), "T01", "A", UNITS[n - 1], 1.0, 0 if n in (10, 40) else 20, 5, n in (10, 40))
            for n in range(1, 41)
        ],
        "fecha date, tienda_id string, sku string, unidades long, importe double, stock int, "
        "en_camino int, quiebre boolean",
    )


@pytest.fixture
def built(fact, catalog, two_stores):
    table = features.feature_rows(fact, star.dim_product(catalog), star.dim_store(two_stores))
    return {r.fecha: r for r in table.collect()}


def test_trailing_windows_end_yesterday(built):
    assert (built[day(1)].media_7, built[day(1)].media_28, built[day(1)].desv_14) == (0, 0, 0)
    assert built[day(1)].dias_cobertura == 999
    assert built[day(2)].media_7 == UNITS[0]
    assert built[day(2)].desv_14 == 0            # one value has no deviation
    assert built[day(8)].media_7 == pytest.approx(sum(UNITS[:7]) / 7)
    assert built[day(29)].media_7 == pytest.approx(sum(UNITS[21:28]) / 7)
    assert built[day(29)].media_28 == pytest.approx(sum(UNITS[:28]) / 28)
    assert built[day(29)].desv_14 == pytest.approx(statistics.stdev(UNITS[14:28]))
    assert built[day(29)].dias_cobertura == pytest.approx(20 / (sum(UNITS[21:28]) / 7))


def test_stock_outs_of_two_weeks(built):
    assert [built[day(n)].quiebres_14 for n in (10, 11, 24, 25, 40)] == [0, 1, 1, 0, 0]


def test_label_looks_one_week_ahead(built):
    labels = {n: built[day(n)].etiqueta for n in range(1, 41)}
    assert [n for n in labels if labels[n] == 1] == [*range(3, 10), *range(33, 40)]
    assert [n for n in labels if labels[n] is None] == [40]


def test_label_on_full_horizons_only(fact, catalog, two_stores):
    table = features.feature_rows(
        fact, star.dim_product(catalog), star.dim_store(two_stores), Params(full_horizon_only=True)
    )
    unknown = rows(table.where("etiqueta IS NULL").orderBy("fecha"), "fecha")
    assert unknown == [(day(n),) for n in range(34, 41)]


def _labelled(spark, labels):
    return spark.createDataFrame(
        [(day(n + 1), v) for n, v in enumerate(labels)], "fecha date, etiqueta int"
    )


def test_split_and_balance(spark):
    # 20 labelled days: the cut is day 13, so 13 train and 7 test.
    table = _labelled(spark, [1, 1, 1] + [0] * 15 + [1, 1] + [None])
    got = features.split_summary(table).first()
    assert (got.corte, got.entrenamiento, got.positivos) == (day(13), 13, 3)
    assert (got.prueba, got.positivos_prueba) == (7, 2)
    assert got.entrenable and got.peso_positivos == pytest.approx(10 / 3)
    apart = features.split_summary(table, Params(embargo_days=7)).first()
    assert (apart.entrenamiento, apart.prueba) == (6, 7)


@pytest.mark.parametrize("labels", [[0] * 20, [1] * 20, [None] * 3, []])
def test_one_class_or_no_label_is_not_trainable(spark, labels):
    got = features.split_summary(_labelled(spark, labels)).first()
    assert not got.entrenable
    assert got.peso_positivos is None


def test_rule_baseline_and_rates(spark):
    cases = [(1, 2.0), (1, 3.0), (1, 3.1), (0, 1.0), (0, 9.0)]
    test = spark.createDataFrame(
        [(y, cover, 3.0) for y, cover in cases],
        "etiqueta int, dias_cobertura double, lead_time double",
    )
    assert tuple(features.rule_baseline(test).first()) == (2, 1, 1, 0.6667, 0.6667)
    quiet = features.rule_baseline(test.where("dias_cobertura > 5")).first()
    assert (quiet.precision_regla, quiet.recall_regla) == (0.0, 0.0)


def test_weights(spark):
    weighted = features.weighted(_labelled(spark, [1, 0]), 2.5)
    assert rows(weighted.orderBy("fecha"), "peso") == [(2.5,), (1.0,)]
