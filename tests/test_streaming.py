from __future__ import annotations

import json

from anaquel.operators import silver
from anaquel.sources import readers
from anaquel.streaming import ingest
from tests.conftest import moment, rows


def sale(venta_id, n=1, **changes):
    body = {
        "venta_id": venta_id, "momento": f"2024-01-0{n}T10:00:00.000250+00:00", "tienda_id": "T01",
        "sku": "A", "unidades": 2, "precio": 1.5, "importe": 3.0,
    }
    return json.dumps({**body, **changes})


def missing(venta_id, field):
    body = json.loads(sale(venta_id))
    del body[field]
    return json.dumps(body)


def put(folder, name, messages, first=0):
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({"value": m, "partition": (first + n) % 3, "offset": first + n})
        for n, m in enumerate(messages)
    ]
    (folder / name).write_text("\n".join(lines))


def messages(spark, folder):
    return spark.readStream.schema("value string, partition int, offset bigint").json(str(folder))


def run(sales, root):
    query = ingest.land(sales, str(root / "datos"), str(root / "control"), available_now=True)
    query.awaitTermination()
    return str(root / "datos")


def test_good_and_bad_messages(spark, tmp_path):
    put(tmp_path / "in", "1.json", [
        sale("a"),
        "{broken",
        missing("b", "precio"),
        sale("c", unidades="muchas"),
        sale("d", extra="ignored"),
    ])
    path = run(ingest.parse_sales(messages(spark, tmp_path / "in")), tmp_path)
    landed = {r.venta_id: r for r in readers.read_stream_landed(spark, path).collect()}
    assert set(landed) == {"a", "b", "d"}
    a = landed["a"]
    assert a.momento == moment(1).replace(microsecond=250)
    assert (a.unidades, a.precio, a.particion, a.offset_kafka) == (2, 1.5, 0, 0)
    assert a.recibido is not None
    assert landed["b"].precio is None  # valid JSON: the batch rules decide about it
    bad = ingest.quarantined(spark, path).orderBy("offset_kafka")
    assert rows(bad, "mensaje", "offset_kafka") == [
        ("{broken", 1), (sale("c", unidades="muchas"), 3),
    ]


def test_every_message_lands_once_across_restarts(spark, tmp_path):
    put(tmp_path / "in", "1.json", [sale("a"), sale("b")])
    sales = lambda: ingest.parse_sales(messages(spark, tmp_path / "in"))
    run(sales(), tmp_path)
    path = run(sales(), tmp_path)  # nothing new
    put(tmp_path / "in", "2.json", [sale("c"), "x"], first=2)
    run(sales(), tmp_path)
    assert sorted(rows(readers.read_stream_landed(spark, path), "venta_id", "offset_kafka")) == [
        ("a", 0), ("b", 1), ("c", 2),
    ]
    assert ingest.quarantined(spark, path).count() == 1


def test_repeated_deliveries_are_dropped_in_stream(spark, tmp_path):
    put(tmp_path / "in", "1.json", [sale(f"s{n}") for n in range(50)] * 2)
    sales = ingest.parse_sales(messages(spark, tmp_path / "in"))
    path = run(ingest.dedupe_deliveries(sales), tmp_path)
    landed = readers.read_stream_landed(spark, path)
    assert landed.count() == 50
    assert landed.select("venta_id").distinct().count() == 50


def test_without_stream_dedupe_the_batch_layer_removes_copies(spark, tmp_path, catalog):
    put(tmp_path / "in", "1.json", [sale("a", 2), sale("a", 1), sale("b")])
    path = run(ingest.parse_sales(messages(spark, tmp_path / "in")), tmp_path)
    landed = readers.read_stream_landed(spark, path)
    none = landed.select("venta_id", "momento", "tienda_id", "sku", "unidades", "precio", "importe")
    reviewed = silver.review_sales(silver.unify_sales(none.where("1 = 0"), landed), catalog)
    clean = {r.venta_id: r.momento.day for r in silver.clean_sales(reviewed).collect()}
    assert clean == {"a": 1, "b": 1}


def test_stream_dedupe_keeps_what_has_no_id_or_does_not_parse(spark, tmp_path):
    put(tmp_path / "in", "1.json", [
        sale("1"), sale("1"), sale("2", 9), missing("x", "venta_id"), missing("y", "venta_id"),
        sale(None), "{broken", "{broken", "",
    ])
    sales = ingest.parse_sales(messages(spark, tmp_path / "in"))
    path = run(ingest.dedupe_deliveries(sales), tmp_path)
    landed = readers.read_stream_landed(spark, path)
    assert sorted(str(r.venta_id) for r in landed.collect()) == ["1", "2", "None", "None", "None"]
    assert ingest.quarantined(spark, path).count() == 3


def test_old_sales_are_not_late(spark, tmp_path):
    put(tmp_path / "in", "1.json", [sale("new", 9)])
    sales = lambda: ingest.dedupe_deliveries(ingest.parse_sales(messages(spark, tmp_path / "in")))
    run(sales(), tmp_path)
    put(tmp_path / "in", "2.json", [sale("old", 1), "x"], first=5)
    path = run(sales(), tmp_path)
    assert {r.venta_id for r in readers.read_stream_landed(spark, path).collect()} == {"new", "old"}
    assert ingest.quarantined(spark, path).count() == 1
