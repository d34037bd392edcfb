from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from anaquel import schemas
from anaquel.operators import silver
from tests.conftest import day, moment, rows


def sale(venta_id, sku="A", unidades=1, precio=2.0, n=1, importe=2.0, tienda="T01"):
    return (venta_id, moment(n), tienda, sku, unidades, precio, importe)


HISTORY = [
    sale(None, sku="X", unidades=0),          # no id wins over every other defect
    sale("h1", sku="X", unidades=0),          # unknown product wins over bad units
    sale("h2", unidades=None),
    sale("h3", unidades=0),
    sale("h4", unidades=-1, precio=0.0),      # bad units win over bad price
    sale("h5", precio=None),
    sale("h6", precio=0.0),
    sale("ok", n=2),
    sale("both", n=3),
    sale("h7", sku=None),                     # a missing product is not in the catalogue
]
STREAM = [
    (*sale("both", n=1, unidades=9), 0, 1, moment(1, 11)),
    (*sale("twice", n=5, unidades=5), 0, 2, moment(5, 11)),
    (*sale("twice", n=4, unidades=4), 1, 3, moment(4, 11)),
]


@pytest.fixture
def reviewed(spark, catalog):
    raw = silver.unify_sales(
        spark.createDataFrame(HISTORY, schemas.VENTA),
        spark.createDataFrame(STREAM, schemas.VENTA_STREAM),
    )
    return silver.review_sales(raw, catalog)


def test_unify_is_a_bag_with_typed_nulls(spark):
    raw = silver.unify_sales(
        spark.createDataFrame(HISTORY, schemas.VENTA),
        spark.createDataFrame(STREAM, schemas.VENTA_STREAM),
    )
    assert raw.count() == len(HISTORY) + len(STREAM)
    assert dict(raw.dtypes)["recibido"] == "timestamp"
    assert dict(raw.dtypes)["offset_kafka"] == "bigint"
    past = raw.where("origen = 'historico'")
    assert past.where("recibido IS NULL AND particion IS NULL").count() == len(HISTORY)


def test_first_broken_rule_is_the_reason(reviewed):
    reasons = {r.venta_id: r.motivo_rechazo for r in reviewed.collect()}
    assert reasons == {
        None: "sin identificador",
        "h1": "sku no catalogado",
        "h2": "unidades no validas",
        "h3": "unidades no validas",
        "h4": "unidades no validas",
        "h5": "precio no valido",
        "h6": "precio no valido",
        "h7": "sku no catalogado",
        "ok": None,
        "both": None,
        "twice": None,
    }


def test_reject_counts(reviewed):
    assert sorted(rows(silver.rejects_by_reason(reviewed))) == [
        ("precio no valido", 2),
        ("sin identificador", 1),
        ("sku no catalogado", 2),
        ("unidades no validas", 3),
    ]


def test_history_wins_then_the_earliest(reviewed):
    clean = {r.venta_id: r for r in silver.clean_sales(reviewed).collect()}
    assert set(clean) == {"ok", "both", "twice"}
    assert (clean["both"].origen, clean["both"].unidades) == ("historico", 1)
    assert (clean["twice"].fecha, clean["twice"].unidades) == (day(4), 4)


def test_quality_report_conserves_rows(reviewed):
    report = silver.quality_report(reviewed).first()
    assert tuple(report) == (13, 3, 8, 2, 23.08)
    assert report.entradas == report.validas + report.rechazadas + report.duplicadas
    counts = silver.review_counts(reviewed)
    assert silver.quality_from_layers(counts, silver.clean_sales(reviewed)).first() == report
    assert sorted(rows(silver.rejects_from_counts(counts))) == sorted(
        rows(silver.rejects_by_reason(reviewed))
    )


def test_quality_of_nothing(spark, catalog):
    empty = silver.review_sales(
        silver.unify_sales(
            spark.createDataFrame([], schemas.VENTA),
            spark.createDataFrame([], schemas.VENTA_STREAM),
        ),
        catalog,
    )
    assert tuple(silver.quality_report(empty).first()) == (0, 0, 0, 0, 0.0)
    stored = silver.quality_from_layers(silver.review_counts(empty), silver.clean_sales(empty))
    assert tuple(stored.first()) == (0, 0, 0, 0, 0.0)
    assert silver.clean_sales(empty).count() == 0


def test_a_repeated_catalogue_entry_does_not_multiply_sales(spark, catalog):
    raw = silver.unify_sales(
        spark.createDataFrame(HISTORY, schemas.VENTA),
        spark.createDataFrame([], schemas.VENTA_STREAM),
    )
    assert silver.review_sales(raw, catalog.union(catalog)).count() == len(HISTORY)


def test_a_third_of_all_rows_under_one_id_keeps_one_row_per_task(spark, catalog):
    copies = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("venta_id"),
        F.lit(moment(1)).alias("momento"), F.lit("T01").alias("tienda_id"), F.lit("A").alias("sku"),
        F.lit(1).alias("unidades"), F.lit(2.0).alias("precio"), F.lit(2.0).alias("importe"),
    )
    raw = silver.unify_sales(copies, spark.createDataFrame([], schemas.VENTA_STREAM))
    clean = silver.clean_sales(silver.review_sales(raw, catalog))
    assert clean.count() == 20_001
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange")[1]


def test_freshness(spark):
    history = spark.createDataFrame([sale("a", n=1), sale(None, n=3, sku="X")], schemas.VENTA)
    at = lambda n: F.lit(dt.datetime.combine(day(n), dt.time(1)))
    assert tuple(silver.feed_freshness(history, at(4)).first()) == (day(3), 1, False)
    assert tuple(silver.feed_freshness(history, at(5)).first()) == (day(3), 2, True)


def test_freshness_from_counts_ignores_the_stream(reviewed):
    at = F.lit(moment(4))
    got = silver.freshness_from_days(silver.review_counts(reviewed), at).first()
    assert tuple(got) == (day(3), 1, False)


def test_live_inventory_beats_history(spark):
    def stock(n, units, empty=False):
        return (day(n), "T01", "A", units, 0, empty, 0, 0, 0, 0.0)

    history = spark.createDataFrame([stock(1, 5), stock(2, 6)], schemas.INVENTARIO)
    live = spark.createDataFrame([stock(2, 0, True), stock(3, 7)], schemas.INVENTARIO)
    merged = silver.merge_inventory(history, live).orderBy("fecha")
    assert rows(merged, "fecha", "stock", "quiebre") == [
        (day(1), 5, False), (day(2), 0, True), (day(3), 7, False),
    ]
    alone = silver.merge_inventory(history, spark.createDataFrame([], schemas.INVENTARIO))
    assert alone.count() == 2


def test_numbers_that_are_no_amounts_are_rejected_and_counted(spark, catalog, tmp_path):
    """From CSV and JSON alike; the good sales of the same cell keep their amount."""
    from anaquel.functions.numeric import rnd
    from anaquel.sources import readers
    from anaquel.streaming import ingest

    head = "venta_id,momento,tienda_id,sku,unidades,precio,importe"
    at = "2024-01-01T10:00:00"
    (tmp_path / "v.csv").write_text("\n".join([
        head, f"a,{at},T01,A,1,2.0,2.0", f"b,{at},T01,A,1,NaN,2.0", f"c,{at},T01,A,1,2.0,NaN",
        f"d,{at},T01,A,1,Infinity,2.0", f"e,{at},T01,A,1,2.0,1e21", f"f,{at},T01,A,1,1e21,2.0",
    ]))
    history = readers.read_sales_history(spark, str(tmp_path / "v.csv"))
    texts = [
        '{"venta_id":"g","momento":"2024-01-01T10:00:00Z","tienda_id":"T01","sku":"A","unidades":1,'
        f'"precio":{p},"importe":{i}}}' for p, i in (("NaN", "1.0"), ("2.0", "1e21"))
    ]
    sent = spark.createDataFrame([(t, 0, n) for n, t in enumerate(texts)], "value string, partition int, offset long")
    landed = ingest.parse_sales(sent).where("estado = 'ok'")
    reviewed = silver.review_sales(silver.unify_sales(history, landed), catalog)
    assert dict(silver.rejects_by_reason(reviewed).collect()) == {"precio no valido": 4, "importe no valido": 3}
    total = silver.clean_sales(reviewed).agg(rnd(F.sum("importe"), 2)).first()[0]
    assert total == 2.0
