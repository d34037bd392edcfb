from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import SparkSession

from anaquel import schemas
from anaquel.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("anaquel-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("compartida")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("almacen")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def day(n: int) -> dt.date:
    """Day 1 is 2024-01-01, a Monday."""
    return dt.date(2023, 12, 31) + dt.timedelta(days=n)


def moment(n: int, hour: int = 10) -> dt.datetime:
    return dt.datetime.combine(day(n), dt.time(hour))


def rows(df, *columns):
    """The rows as plain tuples, in order."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


CATALOG_ROWS = [
    (1, "Pan", "A", "comida", "Horno", 2.0, 10, 6),
    (2, "Vino", "B", "bebida", None, 10.0, 10, None),
]


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame(CATALOG_ROWS, schemas.PRODUCTO)


@pytest.fixture
def two_stores(spark):
    return spark.createDataFrame(
        [("T01", "Centro", 1.0, 2), ("T02", "Norte", 0.5, 4)], schemas.TIENDA
    )
