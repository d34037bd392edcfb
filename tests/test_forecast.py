from __future__ import annotations

import pytest

from anaquel.operators import forecast
from tests.conftest import day, rows


@pytest.fixture
def calendar(spark):
    # Factors alternate, so that seasonality matters.
    return spark.createDataFrame(
        [(day(n), 1, "x", 1.0, 2.0 if n % 2 else 0.5) for n in range(1, 11)],
        "fecha date, mes int, nombre_dia string, indice_ine double, factor_dia double",
    )


@pytest.fixture
def fact(spark):
    # Level 4 times the factor of the day: 8 on odd days, 2 on even days.
    return spark.createDataFrame(
        [(day(n), "T01", "A", 8 if n % 2 else 2) for n in range(1, 11)],
        "fecha date, tienda_id string, sku string, unidades long",
    )


@pytest.fixture
def daily(fact, calendar):
    return forecast.forecast_daily(forecast.deseasonalised(fact, calendar))


def test_deseasonalised_level_is_flat(fact, calendar):
    series = forecast.deseasonalised(fact, calendar)
    assert {r[0] for r in rows(series, "sin_estacion")} == {4.0}


def test_forecast_uses_only_the_days_before(daily):
    got = {r.fecha: (r.pred_base, r.pred_modelo) for r in daily.collect()}
    assert got[day(1)] == (0.0, 0.0)
    assert got[day(2)] == (8.0, 2.0)
    assert got[day(3)] == (5.0, 8.0)
    assert got[day(8)] == (round((8 * 4 + 2 * 3) / 7, 3), 2.0)
    assert got[day(9)] == (round((8 * 3 + 2 * 4) / 7, 3), 8.0)


def test_backtest_and_uplift(daily, calendar):
    metrics = forecast.backtest(daily, calendar).first()
    assert metrics.observaciones == 7
    assert metrics.mae_modelo == 0.0
    assert metrics.wape_modelo == 0.0
    assert metrics.mae_base > 0
    gain = forecast.uplift(forecast.backtest(daily, calendar)).first()
    assert gain.mejora_pct == 100.0


def test_backtest_without_units_has_no_ratio(daily, calendar):
    from pyspark.sql import functions as F

    silent = daily.withColumn("unidades", F.lit(0).cast("bigint"))
    assert forecast.backtest(silent, calendar).first().wape_modelo is None


@pytest.fixture
def factors(spark):
    months = spark.createDataFrame([(m, 1.0) for m in range(1, 13)], "mes int, factor double")
    week = spark.createDataFrame(
        [(d, 2.0 if d in (1, 7) else 1.0) for d in range(1, 8)], "dia int, factor double"
    )
    return months, week


def test_future_calendar(calendar, factors):
    future = forecast.future_calendar(calendar, *factors, 14).orderBy("horizonte")
    got = rows(future)
    assert [r[0] for r in got] == list(range(1, 15))
    assert got[0][1] == day(11) and got[-1][1] == day(24)
    # Day 13 and 14 are a weekend.
    assert [r[2] for r in got[:5]] == [1.0, 1.0, 2.0, 2.0, 1.0]
    assert forecast.future_calendar(calendar.where("1 = 0"), *factors, 14).count() == 0


def test_level_ignores_the_last_day_itself(daily, calendar):
    assert rows(forecast.current_level(daily, calendar)) == [("T01", "A", 4.0)]


def test_horizon_accumulates_unrounded_demand(spark, factors, calendar):
    level = spark.createDataFrame(
        [("T01", "A", 1 / 3), ("T01", "B", -1.0)], "tienda_id string, sku string, nivel double"
    )
    future = forecast.future_calendar(calendar, *factors, 14)
    got = forecast.forecast_horizon(level, future).orderBy("sku", "horizonte").collect()
    a = [r for r in got if r.sku == "A"]
    # 1/3 on weekdays, 2/3 at the weekend: the third day reaches 4/3, not 0.333 + 0.333 + 0.667.
    assert [r.demanda for r in a[:3]] == [0.333, 0.333, 0.667]
    assert [r.demanda_acumulada for r in a[:3]] == [0.333, 0.667, 1.333]
    assert a[-1].demanda_acumulada == 6.0
    totals = [r.demanda_acumulada for r in a]
    assert totals == sorted(totals)
    assert {r.demanda for r in got if r.sku == "B"} == {0.0}
