"""A refresh against a build from all inputs."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from anaquel import schemas
from anaquel.operators import silver, star
from anaquel.plans import incremental
from anaquel.plans.incremental import Fixed
from anaquel.sources import readers, snapshots
from tests.conftest import day, moment, rows

TABLES = ("ventas", "diario", "inventario", "dim_tiempo", "hecho", "pronostico", "variables")
DAYS = 130


@pytest.fixture(scope="module")
def fixed(spark):
    catalog = spark.createDataFrame(
        [(1, "Pan", "A", "comida", "Horno", 2.0, 10, 6), (2, "Vino", "B", "bebida", None, 10.0, 10, None)],
        schemas.PRODUCTO,
    )
    stores = spark.createDataFrame([("T01", "Centro", 1.0, 2), ("T02", "Norte", 0.5, 4)], schemas.TIENDA)
    months = spark.createDataFrame([(m, 1 + m / 100) for m in range(1, 13)], "mes int, factor double")
    return Fixed(catalog, stores, months, readers.weekday_factors(spark))


def sale(n, store="T01", sku="A", name=None, units=None, arrives=None, hour=10):
    """A landed sale of day ``n`` that arrives on day ``arrives``."""
    u = units or 1 + (n * 3) % 5
    return (
        name or f"{n}-{store}-{sku}", moment(n, hour), store, sku, u, 2.0, 2.0 * u,
        moment(arrives or n, 23), 0, n,
    )


def feed(spark, sales):
    fields = {f.name for f in schemas.VENTA_STREAM.fields}
    names = [*schemas.VENTA.fieldNames(), "recibido", "particion", "offset_kafka"]
    assert fields == set(names)
    kinds = {f.name: f.dataType.simpleString() for f in schemas.VENTA_STREAM.fields}
    schema = ", ".join(f"{n} {kinds[n]}" for n in names)
    return spark.createDataFrame(sales, schema).select(schemas.VENTA_STREAM.fieldNames())


@pytest.fixture(scope="module")
def inventory(spark):
    data = [
        (day(n), t, s, (n * 7 + len(t + s)) % 9, n % 3, (n * 7) % 9 == 0)
        for n in range(1, DAYS + 5) for t in ("T01", "T02") for s in "AB"
    ]
    return spark.createDataFrame(
        data, "fecha date, tienda_id string, sku string, stock int, en_camino int, quiebre boolean"
    )


@pytest.fixture(scope="module")
def history(spark):
    data = [(f"h{n}", moment(n), "T02", "B", 1 + n % 4, 10.0, 10.0 * (1 + n % 4)) for n in range(3, 60, 2)]
    return spark.createDataFrame(data, schemas.VENTA)


OLD = [sale(n, t, s) for n in range(3, 100) for t in ("T01", "T02") for s in "AB" if (n + len(t + s)) % 3]


def content(spark, version):
    return {n: sorted(map(str, rows(version.table(spark, n)))) for n in TABLES}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory, fixed, history, inventory):
    """The version of the old sales; each test refreshes a copy, as all its paths are relative."""
    root = tmp_path_factory.mktemp("base")
    incremental.build(spark, f"{root}/a", fixed, history, feed(spark, OLD), inventory)
    return f"{root}/a"


def both(spark, tmp_path, fixed, history, inventory, built, old, new, counted=None):
    """The refreshed version, the base, and a build from everything."""
    if old == OLD:
        shutil.copytree(built, f"{tmp_path}/a")
        base = snapshots.latest(spark, f"{tmp_path}/a")
    else:
        base = incremental.build(spark, f"{tmp_path}/a", fixed, history, feed(spark, old), inventory)
    got = incremental.refresh(spark, f"{tmp_path}/a", fixed, feed(spark, old + new), counted)
    if counted is not None:
        keys = ["fecha", "tienda_id", "sku"]
        inventory = inventory.join(counted.select(*keys), keys, "left_anti").select(*inventory.columns).union(counted)
    if not new and counted is None:
        return got, base, base
    whole = incremental.build(spark, f"{tmp_path}/b", fixed, history, feed(spark, old + new), inventory)
    return got, base, whole


def test_new_days_late_sales_and_copies(spark, tmp_path, fixed, history, inventory, built):
    new = [
        *(sale(n, "T01", "A") for n in range(100, 106)),  # the calendar grows
        sale(20, "T02", "A", name="late", arrives=104),
        sale(41, "T01", "B", name="41-T01-A", units=4, arrives=105, hour=1),  # an earlier copy of a stored sale wins
        sale(70, "T01", "A", name="70-T01-A", units=5, arrives=105, hour=22),  # a later one does not
        sale(30, "T02", "B", name="h31", units=9, arrives=105),  # nor does a stream copy of a history sale
        sale(50, "T01", "SIN", name="bad", arrives=105),
        (None, moment(51), "T01", "A", 1, 2.0, 2.0, moment(105), 0, 1),
    ]
    got, base, whole = both(spark, tmp_path, fixed, history, inventory, built, OLD, new)
    assert content(spark, got) == content(spark, whole)
    assert content(spark, got)["hecho"] != content(spark, base)["hecho"]
    # Month 3 holds no changed sale: its fact stays the folder it was.
    old, now = base.entries["hecho"].periods, got.entries["hecho"].periods
    assert now["2024-03"] == old["2024-03"] and now["2024-01"] != old["2024-01"]
    assert got.notes["marca"] == str(moment(105, 23))


def test_nothing_new_keeps_every_folder(spark, tmp_path, fixed, history, inventory, built):
    got, base, whole = both(spark, tmp_path, fixed, history, inventory, built, OLD, [])
    assert content(spark, got) == content(spark, whole)
    for name in ("ventas", "diario", "hecho", "pronostico", "variables"):
        assert got.entries[name] == base.entries[name]


def test_inventory_changes_days_without_sales(spark, tmp_path, fixed, history, inventory, built):
    counted = inventory.where(F.col("fecha") == F.lit(day(64))).withColumn("stock", F.lit(77)).withColumn(
        "quiebre", F.lit(True)
    )
    got, base, whole = both(spark, tmp_path, fixed, history, inventory, built, OLD, [], counted)
    assert content(spark, got) == content(spark, whole)
    assert got.table(spark, "hecho").where("stock = 77").count() == 4


def test_calendar_can_start_earlier_and_end_earlier(spark, tmp_path, fixed, history, inventory, built):
    """A better copy moves the only sale of the last day to a day before the first."""
    new = [sale(1, "T01", "A", name="120-T01-A", units=3, arrives=125)]
    got, base, whole = both(
        spark, tmp_path, fixed, history, inventory, built, [*OLD, sale(120)], new
    )
    assert content(spark, got) == content(spark, whole)
    assert (got.notes["primera"], got.notes["ultima"]) == (str(day(1)), str(day(99)))


def test_refresh_needs_a_version(spark, tmp_path, fixed):
    with pytest.raises(ValueError):
        incremental.refresh(spark, str(tmp_path), fixed, feed(spark, []))


def test_sales_that_stay_are_not_shuffled(spark, tmp_path, fixed, history, inventory, built, monkeypatch):
    """They go from their period's files to its new files; many small files are put together instead."""
    new = [
        sale(20, "T02", "A", name="late", arrives=104),
        sale(41, "T01", "B", name="41-T01-A", units=4, arrives=105, hour=1),
    ]
    seen, save = [], snapshots.Draft.save_periods

    def noted(draft, name, df, periods=None, *rest, placed=None, **options):
        if name == "ventas" and periods is not None:
            plan = placed._jdf.queryExecution().executedPlan().toString() if placed is not None else "Exchange"
            seen.append("Exchange hashpartitioning" in plan or "SortMergeJoin" in plan or placed is None)
        save(draft, name, df, periods, *rest, **options, **({} if placed is None else {"placed": placed}))

    monkeypatch.setattr(snapshots.Draft, "save_periods", noted)
    got, base, whole = both(spark, tmp_path / "1", fixed, history, inventory, built, OLD, new)
    assert content(spark, got) == content(spark, whole) and seen == [False]
    monkeypatch.setattr(snapshots, "MAX_FILES", 0)
    got, _, _ = both(spark, tmp_path / "2", fixed, history, inventory, built, OLD, new)
    assert content(spark, got) == content(spark, whole) and seen == [False, True]


def test_ids_too_many_for_a_broadcast_change_nothing(spark, tmp_path, fixed, history, inventory, built, monkeypatch):
    new = [sale(41, "T01", "B", name="41-T01-A", units=4, arrives=105, hour=1), sale(30, "T02", "B", name="h31", arrives=105)]
    got, _, _ = both(spark, tmp_path / "1", fixed, history, inventory, built, OLD, new)
    expected = content(spark, got)
    joined = []
    monkeypatch.setattr(incremental, "fits", lambda df: joined.append(df.columns) and False)
    got, _, _ = both(spark, tmp_path / "2", fixed, history, inventory, built, OLD, new)
    assert content(spark, got) == expected and joined


def test_sales_come_beside_those_of_periods_that_lose_none(spark, tmp_path, fixed, history, inventory, built):
    new = [
        sale(20, "T02", "A", name="late", arrives=104),
        sale(42, "T01", "B", name="42-T01-A", units=4, arrives=105, hour=1),  # beats a stored one of month 2
    ]
    got, base, whole = both(spark, tmp_path, fixed, history, inventory, built, OLD, new)
    assert content(spark, got) == content(spark, whole)
    old, now = base.entries["ventas"], got.entries["ventas"]
    assert now.periods["2024-01"] == old.periods["2024-01"] and list(now.more) == ["2024-01"]
    assert rows(spark.read.parquet(f"{got.root}/{now.more['2024-01'][0]}"), "venta_id") == [("late",)]
    assert now.periods["2024-02"] != old.periods["2024-02"]
    # Another refresh keeps both folders of the month, and adds one; the clean-up leaves them all.
    new += [sale(21, "T02", "A", name="later", arrives=110)]
    third = incremental.refresh(spark, got.root, fixed, feed(spark, OLD + new))
    assert third.entries["ventas"].more["2024-01"][0] == now.more["2024-01"][0]
    assert len(third.entries["ventas"].more["2024-01"]) == 2
    snapshots.expire(spark, got.root, keep=1)
    whole = incremental.build(spark, f"{tmp_path}/c", fixed, history, feed(spark, OLD + new), inventory)
    assert content(spark, snapshots.latest(spark, got.root)) == content(spark, whole)
    # A sale of it that is beaten has the month written again, in one folder.
    new += [sale(20, "T02", "B", name="late", units=5, arrives=115, hour=1)]
    fourth = incremental.refresh(spark, got.root, fixed, feed(spark, OLD + new))
    assert fourth.entries["ventas"].more is None
    whole = incremental.build(spark, f"{tmp_path}/d", fixed, history, feed(spark, OLD + new), inventory)
    assert content(spark, fourth) == content(spark, whole)


def test_sales_clean_so_far_and_landed_ones_are_as_all_cleaned_at_once(spark, fixed, history):
    late = [
        sale(20, "T02", "A", name="late", arrives=104), sale(20, "T02", "A", name="late", units=9, arrives=104, hour=11),
        sale(42, "T01", "B", name="42-T01-A", units=4, arrives=105, hour=1),
        sale(70, "T01", "A", name="70-T01-A", units=5, arrives=105, hour=22),
        sale(30, "T02", "B", name="h31", units=9, arrives=105),
        sale(50, "T01", "SIN", name="bad", arrives=105),
        (None, moment(51), "T01", "A", 1, 2.0, 2.0, moment(105), 0, 1), ("no day", None, "T01", "A", 1, 2.0, 2.0, None, 0, 1),
    ]
    products = star.dim_product(fixed.catalog)

    def clean(landed):
        return silver.clean_sales(silver.review_sales(silver.unify_sales(history, landed), products))

    got = incremental.with_landed(clean(feed(spark, OLD)), feed(spark, late), products)
    expected = clean(feed(spark, OLD + late))
    assert got.columns == expected.columns
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(expected)))


def test_inventory_can_be_made_from_the_clean_sales(spark, tmp_path, fixed, history, inventory):
    seen = []

    def made(sales):
        seen.append(sales.count())
        return inventory

    got = incremental.build(spark, f"{tmp_path}/a", fixed, history, feed(spark, OLD), made)
    whole = incremental.build(spark, f"{tmp_path}/b", fixed, history, feed(spark, OLD), inventory)
    assert content(spark, got) == content(spark, whole)
    assert seen == [whole.table(spark, "ventas").count()]
