from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from anaquel import schemas
from anaquel.operators import season, star
from anaquel.sources import readers
from tests.conftest import day, moment, rows


@pytest.fixture
def months(spark):
    return spark.createDataFrame([(m, 1.0 + m / 10) for m in range(1, 13)], "mes int, factor double")


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [
            (day(1), "T01", "A", 2, 4.0),
            (day(1), "T01", "A", 3, 6.1),
            (day(4), "T02", "B", 1, 10.0),
        ],
        "fecha date, tienda_id string, sku string, unidades int, importe double",
    )


def test_dimensions(catalog, two_stores):
    assert rows(star.dim_product(catalog).orderBy("sku")) == [
        ("A", "Pan", "comida", "Horno", 2.0, 6),
        ("B", "Vino", "bebida", None, 10.0, 1),
    ]
    assert rows(star.dim_store(two_stores).orderBy("tienda_id")) == [
        ("T01", "Centro", 2), ("T02", "Norte", 4),
    ]


def test_calendar_covers_the_gaps_with_both_factors(spark, sales, months):
    calendar = star.dim_date(sales, months, readers.weekday_factors(spark)).orderBy("fecha")
    assert rows(calendar) == [
        (day(1), 1, "Monday", 1.1, 0.88),
        (day(2), 1, "Tuesday", 1.1, 0.86),
        (day(3), 1, "Wednesday", 1.1, 0.92),
        (day(4), 1, "Thursday", 1.1, 1.00),
    ]


def test_weekday_factors_follow_the_week(spark):
    factors = dict(rows(readers.weekday_factors(spark)))
    assert factors == {1: 0.62, 2: 0.88, 3: 0.86, 4: 0.92, 5: 1.00, 6: 1.22, 7: 1.35}


def test_no_sales_no_calendar(spark, sales, months):
    empty = star.dim_date(sales.where("1 = 0"), months, readers.weekday_factors(spark))
    assert empty.count() == 0


def test_a_far_date_makes_a_long_calendar(spark, sales, months):
    broken = sales.withColumn(
        "fecha", F.when(F.col("sku") == "B", F.lit(dt.date(1700, 1, 1))).otherwise(F.col("fecha"))
    )
    days = star.dim_date(broken, months, readers.weekday_factors(spark))
    first, last, n = days.agg(F.min("fecha"), F.max("fecha"), F.count("*")).first()
    assert first == dt.date(1700, 1, 1) and n == (last - first).days + 1 > 100_000
    two = spark.createDataFrame([("T01",), ("T02",)], "tienda_id string")
    products = spark.createDataFrame([("A",)], "sku string")
    assert star.series_grid(days, two, products).count() == 2 * n


def test_reconciliation_names_the_sales_that_no_cell_holds(spark):
    sales = spark.createDataFrame(
        [("T01", "A", dt.date(2024, 1, 1), 2), ("T01", "A", None, 3), ("T99", "A", dt.date(2024, 1, 1), 5)],
        "tienda_id string, sku string, fecha date, unidades int",
    )
    fact = spark.createDataFrame([(2,), (0,)], "unidades long")
    stores = spark.createDataFrame([("T01",)], "tienda_id string")
    got = {r.causa: tuple(r)[1:] for r in star.fact_reconciliation(sales, fact, stores).collect()}
    assert got == {
        "en hecho": (1, 2, 2), "sin fecha": (1, 3, None), "tienda desconocida": (1, 5, None),
    }


def test_daily_totals(sales):
    daily = star.sales_daily(sales).orderBy("fecha")
    assert rows(daily) == [(day(1), "T01", "A", 5, 10.1), (day(4), "T02", "B", 1, 10.0)]


def test_dense_fact_fills_every_cell(spark, sales, months, catalog, two_stores):
    calendar = star.dim_date(sales, months, readers.weekday_factors(spark))
    inventory = spark.createDataFrame(
        [
            (day(1), "T01", "A", 9, 3, True, 0, 0, 0, 0.0),
            (day(9), "T01", "A", 1, 1, True, 0, 0, 0, 0.0),   # outside the calendar
            (day(1), "T09", "A", 1, 1, True, 0, 0, 0, 0.0),   # unknown store
        ],
        schemas.INVENTARIO,
    )
    fact = star.dense_fact(calendar, two_stores, catalog, star.sales_daily(sales), inventory)
    assert fact.count() == 4 * 2 * 2
    assert rows(fact.where("unidades > 0 OR stock > 0").orderBy("fecha")) == [
        (day(1), "T01", "A", 5, 10.1, 9, 3, True),
        (day(4), "T02", "B", 1, 10.0, 0, 0, False),
    ]
    check = star.grid_check(fact, calendar, two_stores, catalog).first()
    assert tuple(check) == (16, 16, True)
    short = star.grid_check(fact.limit(15), calendar, two_stores, catalog).first()
    assert not short.cuadra


def test_seasonal_index_drops_bad_rows_and_fills_empty_months(spark):
    series = spark.createDataFrame(
        [(1, 100.0), (1, 200.0), (2, 50.0), (2, None), (13, 999.0), (0, 999.0), (None, 5.0)],
        schemas.OBSERVACION,
    )
    factors = dict(rows(season.seasonal_index(series)))
    assert factors == {1: 1.5, 2: 0.5, **{m: 1.0 for m in range(3, 13)}}


def test_last_date(spark, sales, months):
    calendar = star.dim_date(sales, months, readers.weekday_factors(spark))
    assert rows(spark.range(1).select(star.last_date(calendar))) == [(day(4),)]
    assert moment(4).date() == day(4)
