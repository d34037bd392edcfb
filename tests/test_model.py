from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from anaquel.operators import features, model
from anaquel.settings import Params
from tests.conftest import day, rows

PARAMS = Params(arboles=8, profundidad=4)


@pytest.fixture(scope="module")
def table(spark):
    """60 days of 12 series; low cover means a stock-out soon, with some noise."""
    data = []
    for n in range(1, 61):
        for s in range(12):
            noise = (n * 31 + s * 17) % 10
            cover = float((n * 7 + s * 5) % 20)
            label = None if n == 60 else int(cover < 6 if noise else cover >= 6)
            data.append((day(n), f"T0{s % 3}", f"S{s}", f"C{s % 4}", 3.0, cover * 2, 1.0, 2.0, 2.0,
                         0.5, noise % 3, label, cover))
    return spark.createDataFrame(
        data,
        "fecha date, tienda_id string, sku string, categoria string, lead_time double, "
        "stock double, en_camino double, media_7 double, media_28 double, desv_14 double, "
        "quiebres_14 long, etiqueta int, dias_cobertura double",
    )


@pytest.fixture(scope="module")
def trained(table):
    return model.train(table, PARAMS)


@pytest.fixture(scope="module")
def scored(table, trained):
    """Label, score, prediction and rule inputs of the test week, as plain rows."""
    test = table.where((F.col("fecha") > F.lit(day(52))) & F.col("etiqueta").isNotNull())
    from pyspark.ml.functions import vector_to_array

    out = trained.model.transform(test).select(
        "etiqueta", vector_to_array("probability")[1].alias("p"), "prediction",
        "dias_cobertura", "lead_time",
    )
    return out.collect()


def test_confusion_and_rates_equal_a_recount(trained, scored):
    m = trained.metrics.first()
    count = lambda y, p: sum(r.etiqueta == y and r.prediction == p for r in scored)
    assert (m.vp, m.fp, m.fn, m.vn) == (count(1, 1), count(0, 1), count(1, 0), count(0, 0))
    assert m.precision == round(m.vp / (m.vp + m.fp), 4)
    assert m.recall == round(m.vp / (m.vp + m.fn), 4)
    warned = [r for r in scored if r.dias_cobertura <= r.lead_time]
    hits = sum(r.etiqueta for r in warned)
    assert m.precision_regla == round(hits / len(warned), 4)
    assert m.recall_regla == round(hits / sum(r.etiqueta for r in scored), 4)
    assert len(scored) == 7 * 12


def test_auc_equals_the_share_of_ordered_pairs(trained, scored):
    up = [r.p for r in scored if r.etiqueta == 1]
    down = [r.p for r in scored if r.etiqueta == 0]
    pairs = sum((a > b) + 0.5 * (a == b) for a in up for b in down)
    assert trained.metrics.first().auc == pytest.approx(pairs / (len(up) * len(down)), abs=2e-4)
    assert trained.metrics.first().auc > 0.7


def test_weight_balances_the_classes(table, trained):
    summary = features.split_summary(table, PARAMS).first()
    negatives = summary.entrenamiento - summary.positivos
    assert trained.metrics.first().peso_positivos == round(negatives / summary.positivos, 2)


def test_importance_covers_all_nine_variables(trained):
    weights = dict(rows(trained.importance))
    assert len(weights) == 9 and "categoria" in weights
    assert sum(weights.values()) == pytest.approx(1, abs=1e-3)
    assert max(weights, key=weights.get) in ("stock", "dias_cobertura")


def test_same_trees_from_any_partitioning(table, trained):
    again = model.train(table.repartition(3, "sku").orderBy(F.desc("fecha")), PARAMS)
    assert again.model.stages[-1].toDebugString.split("\n", 1)[1] == (
        trained.model.stages[-1].toDebugString.split("\n", 1)[1]
    )


def test_remembered_nodes_do_not_change_the_trees(table, trained):
    plain = model.train(table, replace(PARAMS, guardar_nodos=False))
    assert rows(plain.importance) == rows(trained.importance)
    assert rows(plain.metrics) == rows(trained.metrics)


def test_any_number_of_categories(table):
    many = table.withColumn("categoria", F.concat(F.lit("c"), F.pmod(F.xxhash64("sku", "fecha"), F.lit(40))))
    assert many.select("categoria").distinct().count() == 40
    trained = model.train(many, PARAMS)
    assert len(trained.model.stages[0].labels) == 40 and trained.metrics.count() == 1


def test_training_rows_can_be_bounded(table, trained):
    some = model.train(table, replace(PARAMS, filas_entrenamiento=table.count() // 3))
    assert rows(some.importance) != rows(trained.importance)
    every = model.train(table, replace(PARAMS, filas_entrenamiento=10**9))
    assert rows(every.importance) == rows(trained.importance)


def test_unknown_category_is_still_scored(table, trained):
    strange = table.where(F.col("fecha") == F.lit(day(60))).withColumn("categoria", F.lit("nueva"))
    chances = rows(model.score(trained.model, strange, F.lit(day(60))), "probabilidad")
    assert len(chances) == 12
    assert all(0 <= p <= 1 for (p,) in chances)


@pytest.mark.parametrize("label", [0, 1, None])
def test_nothing_to_learn(table, label):
    flat = table.withColumn("etiqueta", F.lit(label).cast("int"))
    assert model.train(flat, PARAMS) is None
