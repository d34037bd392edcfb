from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException

from anaquel import schemas
from anaquel.operators import season, serving
from anaquel.session import scratch_path, shared_dir, stage, stage_by_series
from anaquel.sources import readers, writers
from tests.conftest import CATALOG_ROWS, day, moment, rows

SALES_CSV = """venta_id,momento,tienda_id,sku,unidades,precio,importe
a,2024-01-01T09:30:00+00:00,T01,A,2,1.5,3.0
b,2024-01-01T23:30:00-02:00,T01,A,dos,1.5,3.0
,2024-01-02T10:00:00.250000+00:00,T02,B,-1,,0
"""

INVENTORY_CSV = """fecha,tienda_id,sku,stock,en_camino,quiebre,demanda,vendidas,no_atendidas,valor_no_atendido
2024-01-01,T01,A,0,4,True,3,2,1,2.5
2024-01-02,T01,A,7,0,False,1,1,0,0.0
"""


def test_catalogue_document(spark, tmp_path):
    names = schemas.PRODUCTO.fieldNames()
    products = [dict(zip(names, r)) for r in CATALOG_ROWS]
    del products[1]["brand"], products[1]["minimumOrderQuantity"]
    path = tmp_path / "catalogo.json"
    path.write_text(json.dumps({"products": products}, indent=1))
    assert rows(readers.read_catalog(spark, str(path)).orderBy("id")) == CATALOG_ROWS


def test_index_series_document_to_factors(spark, tmp_path):
    path = tmp_path / "ine.json"
    path.write_text(json.dumps({
        "Nombre": "serie",
        "Data": [
            {"FK_Periodo": 1, "Valor": 3.0, "Anyo": 2023},
            {"FK_Periodo": 2, "Valor": 1.0, "Anyo": 2023},
            {"FK_Periodo": 3, "Valor": None, "Anyo": 2023},
        ],
    }, indent=1))
    factors = dict(rows(season.seasonal_index(readers.read_index_series(spark, str(path)))))
    assert factors == {1: 1.5, 2: 0.5, **{m: 1.0 for m in range(3, 13)}}


def test_month_factor_document(spark, tmp_path):
    path = tmp_path / "factores_mes.json"
    path.write_text(json.dumps({str(m): m / 10 for m in range(1, 13)}, indent=1))
    assert dict(rows(readers.read_month_factors(spark, str(path)))) == {
        m: m / 10 for m in range(1, 13)
    }


def test_sales_csv_is_typed_and_one_bad_cell_stays_one_bad_cell(spark, tmp_path):
    path = tmp_path / "ventas.csv"
    path.write_text(SALES_CSV)
    got = readers.read_sales_history(spark, str(path))
    assert got.schema == schemas.VENTA
    a, b, c = sorted(rows(got), key=lambda r: str(r[1]))
    assert a == ("a", moment(1, 9).replace(minute=30), "T01", "A", 2, 1.5, 3.0)
    assert (b[0], b[1], b[4], b[5]) == ("b", moment(2, 1).replace(minute=30), None, 1.5)
    assert (c[0], c[4], c[5]) == (None, -1, None)


def test_inventory_csv(spark, tmp_path):
    path = tmp_path / "inventario.csv"
    path.write_text(INVENTORY_CSV)
    got = rows(readers.read_inventory_history(spark, str(path)).orderBy("fecha"))
    assert got == [
        (day(1), "T01", "A", 0, 4, True, 3, 2, 1, 2.5),
        (day(2), "T01", "A", 7, 0, False, 1, 1, 0, 0.0),
    ]


def test_absent_feeds_are_empty_and_typed(spark, tmp_path):
    nowhere = str(tmp_path / "nada")
    assert readers.read_inventory_live(spark, nowhere).schema == schemas.INVENTARIO
    assert readers.read_stream_landed(spark, nowhere).schema == schemas.VENTA_STREAM
    assert readers.read_stream_landed(spark, nowhere, "csv").count() == 0
    assert readers.read_probability(spark, nowhere).count() == 0
    (tmp_path / "vacia").mkdir()
    assert readers.read_stream_landed(spark, str(tmp_path / "vacia"), "csv").count() == 0


def test_other_read_errors_are_not_hidden(spark):
    with pytest.raises(AnalysisException):
        readers._or_empty(spark, schemas.VENTA, lambda: spark.sql("SELECT missing_column"))


def test_landed_csv_batches(spark, tmp_path):
    head = "venta_id,momento,tienda_id,sku,unidades,precio,importe,particion,offset_kafka,recibido\n"
    for n in (1, 2):
        (tmp_path / f"2024010{n}T100000.csv").write_text(
            head + f"s{n},2024-01-0{n}T10:00:00+00:00,T01,A,1,2.0,2.0,0,{n},"
            f"2024-01-0{n}T10:00:05+00:00\n"
        )
    (tmp_path / "notas.txt").write_text("not a batch")
    got = readers.read_stream_landed(spark, str(tmp_path), "csv").orderBy("venta_id")
    assert rows(got, "venta_id", "offset_kafka") == [("s1", 1), ("s2", 2)]
    assert rows(got, "recibido")[0][0] == moment(1).replace(second=5)


def test_parquet_round_trip_and_overwrite(spark, catalog, tmp_path):
    path = str(tmp_path / "t")
    writers.save(catalog.union(catalog), path)
    again = writers.materialise(catalog, path)
    assert sorted(rows(again)) == sorted(rows(catalog))
    assert again.schema == catalog.schema


def test_series_tables_need_no_shuffle(spark, tmp_path):
    df = spark.range(200).selectExpr(
        "concat('T', id % 5) AS tienda_id", "concat('S', id % 7) AS sku",
        "date_add(DATE '2024-01-01', int(id)) AS fecha", "id AS unidades",
    )
    path = str(tmp_path / "serie")
    for _ in range(2):  # the second write replaces the first
        stored = writers.materialise_by_series(df, path, 4)
    assert stored.count() == 200
    totals = stored.groupBy("tienda_id", "sku").sum("unidades")
    assert "Exchange" not in totals._jdf.queryExecution().executedPlan().toString()
    assert spark.read.parquet(path).count() == 200


def test_partition_column_comes_back_from_the_path(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 7)], "sku string, horizonte int")
    stored = writers.save_partitioned(df, str(tmp_path / "riesgo"))
    assert sorted(rows(stored, "sku", "horizonte")) == [("a", 1), ("b", 7)]
    assert sorted(p.name for p in (tmp_path / "riesgo").glob("h*")) == ["horizonte=1", "horizonte=7"]
    assert readers.read_gold(spark, str(tmp_path / "riesgo")).count() == 2


def test_csv_export_keeps_the_order(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "100 - id AS v").orderBy("v")
    writers.export_csv(df, str(tmp_path / "out"))
    lines = [
        line
        for part in sorted((tmp_path / "out").glob("part-*.csv"))
        for line in part.read_text().splitlines()
        if line != "id,v"
    ]
    assert lines == [f"{i},{100 - i}" for i in range(99, -1, -1)]


def test_json_snapshot_keeps_missing_values(spark, catalog, tmp_path):
    path = str(tmp_path / "productos")
    writers.save_json(catalog, path)
    assert sorted(rows(spark.read.schema(schemas.PRODUCTO).json(path))) == sorted(CATALOG_ROWS)


def test_manifest_grows_and_shows_the_newest_first(spark, tmp_path):
    path = str(tmp_path / "manifiesto")
    for n in (2, 1, 3):
        load = spark.createDataFrame(
            [(f"2024-01-0{n}T00:00:00+00:00", "origen", "f.json", n)], schemas.CARGA
        )
        writers.append_manifest(load, path)
    manifest = readers.read_manifest(spark, path)
    assert rows(serving.latest_loads(manifest), "registros") == [(3,), (2,), (1,)]
    assert rows(serving.latest_loads(manifest, 1), "registros") == [(3,)]
    with pytest.raises(ValueError):
        serving.latest_loads(manifest, 501)


def test_scratch_lives_in_the_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    assert scratch_path(spark, "x").startswith(configured)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_stage_cuts_the_lineage(spark):
    staged = stage(spark.range(10).selectExpr("id", "id * 2 AS doble"), "corte")
    assert "FileScan parquet" in staged._jdf.queryExecution().executedPlan().toString()
    assert staged.count() == 10


def test_stage_by_series_cuts_the_lineage(spark):
    df = spark.range(10).selectExpr(
        "'T01' AS tienda_id", "'A' AS sku", "date_add(DATE '2024-01-01', int(id)) AS fecha"
    )
    assert stage_by_series(df, "corte").count() == 10


def test_another_header_order_is_an_error(spark, tmp_path):
    path = tmp_path / "ventas.csv"
    path.write_text(SALES_CSV.replace("precio,importe", "importe,precio", 1))
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_sales_history(spark, str(path)).collect()


def test_broken_lines_are_kept_with_their_text(spark, tmp_path):
    header = ",".join(schemas.VENTA.fieldNames())
    good = ["a,2024-01-01T10:00:00.000Z,T01,A,2,1.5,3.0", "b,,T01,A,,1.5,", ",2024-01-01T10:00:00.000Z,T01,A,2,1.5,3.0"]
    bad = [
        "c,2024-01-01T10:00:00.000Z,T01,A,muchas,1.5,3.0", "d,2024-01-01T10:00:00.000Z,T01", "e,ayer,T01,A,2,1.5,3.0",
        "f,2024-01-01T10:00:00.000Z,T01,A,2,1.5,3.0,9",
    ]
    (tmp_path / "v.csv").write_text("\n".join([header, *good, *bad]) + "\n")
    sales, broken = readers.read_sales_checked(spark, str(tmp_path / "v.csv"))
    assert [r.venta_id for r in sales.collect()] == ["a", "b", None]
    assert sales.columns == schemas.VENTA.fieldNames()
    assert sorted(rows(broken)) == sorted(("v.csv", line, readers.ILEGIBLE) for line in bad)
    assert sales.count() + broken.count() == len(good) + len(bad)
