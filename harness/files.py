"""Sources and sinks on files: derived inputs written out in the input formats and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel import schemas
from anaquel.operators import serving
from anaquel.plans import pipeline
from anaquel.session import scratch_path
from anaquel.sources import readers, writers
from anaquel.streaming import ingest, log, replay, settle
from harness.derive import Domain
from harness.oracle import TABLES


def scan_catalog(d: Domain) -> DataFrame:
    """JSON documents that each hold an array of at most ten products."""
    path = scratch_path(d.spark, "catalogo")
    product = F.struct(*schemas.PRODUCTO.fieldNames())
    pages = d.catalog.groupBy(F.floor(F.col("id") / 10)).agg(
        F.collect_list(product).alias("products")
    )
    pages.select("products").write.option("maxRecordsPerFile", 1).json(path)
    return readers.read_catalog(d.spark, path)


def scan_index_series(d: Domain) -> DataFrame:
    path = scratch_path(d.spark, "indice")
    pages = d.index_series.groupBy("FK_Periodo").agg(
        F.collect_list(F.struct("FK_Periodo", "Valor")).alias("Data")
    )
    pages.select("Data").write.option("maxRecordsPerFile", 1).json(path, ignoreNullFields=False)
    return readers.read_index_series(d.spark, path)


def scan_month_factor(d: Domain) -> DataFrame:
    path = scratch_path(d.spark, "factores")
    entries = F.collect_list(F.struct(F.col("mes").cast("string"), "factor"))
    document = d.month_factor.agg(F.to_json(F.map_from_entries(entries)).alias("value"))
    document.write.text(path)
    return readers.read_month_factors(d.spark, path)


def scan_sales_csv(d: Domain) -> DataFrame:
    path = scratch_path(d.spark, "ventas_historico")
    writers.export_csv(d.history, path)
    return readers.read_sales_history(d.spark, path)


def _broken_feed(d: Domain) -> str:
    """The history as CSV; every 50th order's units are spelled out, every 70th's lines have a field too many."""
    path = scratch_path(d.spark, "ventas_rotas")
    order = F.expr("try_cast(substring_index(venta_id, '-', 1) AS bigint)")
    spelled = d.history.withColumns({
        "unidades": F.when(order % 50 == 1, F.lit("muchas")).otherwise(F.col("unidades").cast("string")),
        "importe": F.when(order % 70 == 2, F.concat(F.col("importe").cast("string"), F.lit(",9")))
        .otherwise(F.col("importe").cast("string")),
    })
    # Commas in the last field must not be quoted: no value holds the quote character chosen.
    spelled.write.option("quote", "\u0000").option("escapeQuotes", "false").csv(path, header=True)
    return path


def rescued_sales(d: Domain) -> DataFrame:
    return readers.read_sales_checked(d.spark, _broken_feed(d))[0]


def rescued_lines(d: Domain) -> DataFrame:
    """Lines per outcome, next to the lines of the feed."""
    path = _broken_feed(d)
    good, bad = readers.read_sales_checked(d.spark, path)
    read = d.spark.read.text(path).where(~F.startswith("value", F.lit("venta_id,"))).agg(F.count("*")).scalar()
    outcomes = good.select(F.lit("leida").alias("motivo")).union(bad.select("motivo"))
    return outcomes.groupBy("motivo").agg(F.count("*").alias("lineas")).withColumn("de", read)


def scan_stream_landed(d: Domain) -> DataFrame:
    path = scratch_path(d.spark, "ventas_stream")
    writers.export_csv(d.landed, path)
    return readers.read_stream_landed(d.spark, path, fmt="csv")


def scan_inventory_csv(d: Domain) -> DataFrame:
    path = scratch_path(d.spark, "inventario_csv")
    writers.export_csv(d.inventory_history, path)
    return readers.read_inventory_history(d.spark, path)


def sink_roundtrip(d: Domain) -> DataFrame:
    return writers.materialise(d.daily, scratch_path(d.spark, "ventas_dia"))


def sink_json_roundtrip(d: Domain) -> DataFrame:
    root = scratch_path(d.spark, "bronce")
    return pipeline.load_snapshot(d.catalog, root, "instantanea/catalogo", "catalogo de productos")


def sink_csv_roundtrip(d: Domain) -> DataFrame:
    path = scratch_path(d.spark, "alertas")
    alerts = serving.open_alerts(d.risk())
    writers.export_csv(alerts, path)
    return d.spark.read.schema(alerts.schema).csv(path, header=True)


def risk_partitioned(d: Domain) -> DataFrame:
    return writers.save_partitioned(d.risk(), scratch_path(d.spark, "hecho_riesgo"))


def lineage(d: Domain) -> DataFrame:
    """One load per given table, appended to a manifest and read back."""
    root = scratch_path(d.spark, "bronce")
    for n, name in enumerate(TABLES):
        day = F.date_add(F.lit("2001-11-01").cast("date"), n).cast("timestamp")
        pipeline.log_load(d.table(name), root, f"{name}.parquet", name, day)
    return serving.latest_loads(readers.read_manifest(d.spark, f"{root}/_manifiesto"))


def _event_messages(d: Domain) -> DataFrame:
    """The event table as a stream of JSON sales; error events are sent as broken text."""
    events = (
        d.spark.readStream.schema(
            "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
        )
        .option("pathGlobFilter", "events.parquet")
        .parquet(d.sf_dir)
    )
    return events.select(
        _event_body(F.col("ts")).alias("value"),
        (F.col("event_type") == "error").alias("roto"),
        (F.col("user_id") % 3).alias("partition"),
        F.col("event_id").alias("offset"),
    )


def _event_body(moment: Column) -> Column:
    return F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("venta_id"),
            F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("momento"),
            F.concat(F.lit("T0"), F.col("user_id") % 5 + 1).alias("tienda_id"),
            F.col("event_type").alias("sku"),
            F.lit(1).alias("unidades"),
            F.col("value").alias("precio"),
            F.col("value").alias("importe"),
        )
    )


def _landed(d: Domain, sales: DataFrame, name: str) -> str:
    path = scratch_path(d.spark, name)
    query = ingest.land(sales, f"{path}/datos", f"{path}/control", available_now=True)
    query.awaitTermination()
    return f"{path}/datos"


def _event_sales(d: Domain) -> DataFrame:
    broken = F.when(F.col("roto"), F.concat(F.lit("x"), "value")).otherwise(F.col("value"))
    return ingest.parse_sales(_event_messages(d).withColumn("value", broken))


def stream_ingest(d: Domain) -> DataFrame:
    """Accepted messages; the arrival time is left out because it differs between runs."""
    path = _landed(d, _event_sales(d), "ingesta")
    return readers.read_stream_landed(d.spark, path).drop("recibido")


def stream_quarantine(d: Domain) -> DataFrame:
    path = _landed(d, _event_sales(d), "cuarentena")
    return ingest.quarantined(d.spark, path).select("particion", "offset_kafka")


def stream_dedup(d: Domain) -> DataFrame:
    """Every event delivered twice: sales with an id stay once, all other messages stay.

    Error events are broken texts, and every seventh sale has lost its id; their second delivery has a
    place of its own in the log, so it is another message.
    """
    sent = _event_messages(d)
    nameless = F.col("offset") % 7 == 0
    text = F.when(F.col("roto"), F.concat(F.lit("x"), "value")).when(
        nameless, F.regexp_replace("value", '"venta_id":"[0-9]+",', "")
    ).otherwise(F.col("value"))
    sent = sent.withColumn("value", text)
    again = sent.withColumn("offset", -F.col("offset") - 1)
    path = _landed(
        d, ingest.dedupe_deliveries(ingest.parse_sales(sent.unionByName(again))), "unicas"
    )
    landed = d.spark.read.schema(schemas.VENTA_LANDED).parquet(path)
    # Which of two deliveries stays depends on their order in the batch: the place is left out there.
    place = F.col("venta_id").isNull()
    return landed.select(
        "venta_id", "momento", "sku", "precio", "estado",
        F.when(place, F.col("offset_kafka")).alias("offset_kafka"),
    )


def _deliveries(d: Domain) -> DataFrame:
    """The events as messages of a log: broken texts for errors, arrival up to two minutes after the event."""
    body = _event_body(F.col("ts"))
    return d.table("events").select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("x"), body)).otherwise(body).alias("value"),
        (F.col("user_id") % 3).alias("partition"),
        F.col("event_id").alias("offset"),
        (F.col("ts").cast("timestamp") + F.make_dt_interval(secs=F.col("event_id") % 120)).alias("timestamp"),
        "event_id",
    )


def _log_sales(d: Domain, path: str) -> DataFrame:
    return ingest.parse_sales(log.messages(d.spark, path), arrival=F.col("timestamp"))


def stream_log(d: Domain) -> DataFrame:
    """The events written to a log in two commits; the ingest reads the first, stops, and goes on from its checkpoint."""
    path, sent = scratch_path(d.spark, "registro"), _deliveries(d)
    half = sent.agg(F.max("event_id")).first()[0] // 2
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        log.append(sent.where(part), path)
        query = ingest.land(_log_sales(d, path), f"{path}/datos", f"{path}/control", available_now=True)
        query.awaitTermination()
    return readers.read_stream_landed(d.spark, f"{path}/datos")


def stream_preferred(d: Domain) -> DataFrame:
    """Every event delivered twice, five minutes apart; of every third the second delivery is the better one.

    A nameless message a day later lets the watermark pass the last sale; it is still open itself.
    """
    path, body = scratch_path(d.spark, "registro"), _event_body(F.col("momento"))
    broken = F.col("event_type") == "error"
    events = d.table("events")
    first = events.withColumn("momento", F.col("ts")).withColumn("n", F.lit(0))
    earlier = F.col("ts") - F.make_dt_interval(secs=F.when(F.col("event_id") % 3 == 0, 1).otherwise(-1))
    again = events.withColumn("momento", earlier).withColumn("n", F.lit(1))
    sent = first.unionByName(again).select(
        F.when(broken, F.concat(F.lit("x"), body)).otherwise(body).alias("value"),
        (F.col("user_id") % 3).alias("partition"),
        (F.col("event_id") * 2 + F.col("n")).alias("offset"),
        (F.col("ts").cast("timestamp") + F.make_dt_interval(mins=F.col("n") * 5)).alias("timestamp"),
    )
    later = sent.agg(
        F.lit("").alias("value"), F.lit(3).alias("partition"), F.lit(0).alias("offset"),
        (F.max("timestamp") + F.make_dt_interval(days=F.lit(1))).alias("timestamp"),
    )
    log.append(sent.unionByName(later), path)
    sales = settle.preferred_deliveries(_log_sales(d, path))
    replay.drain(replay.land_batches(sales, f"{path}/datos", f"{path}/control", seconds=0))
    return d.spark.read.schema(sales.schema).parquet(f"{path}/datos").drop("mensaje", "ejecucion", "lote")


def _minutes(d: Domain) -> DataFrame:
    path = scratch_path(d.spark, "registro")
    log.append(_deliveries(d), path)
    updates = settle.latency_by_minute(_log_sales(d, path))
    replay.land_batches(updates, f"{path}/datos", f"{path}/control", "update", available_now=True).awaitTermination()
    return settle.current_minutes(replay.read_batches(d.spark, f"{path}/datos", updates.schema))


def stream_latency(d: Domain) -> DataFrame:
    return _minutes(d)


def stream_latency_total(d: Domain) -> DataFrame:
    return settle.latency_total(_minutes(d))


def stream_replay(d: Domain) -> DataFrame:
    """Broken texts mended in two goes, the first of which can't mend all, each go run again with a new checkpoint."""
    path = scratch_path(d.spark, "registro")
    log.append(_deliveries(d), path)
    landed, mended = f"{path}/datos", f"{path}/reparadas"
    ingest.land(_log_sales(d, path), landed, f"{path}/control", available_now=True).awaitTermination()
    one_store = lambda text: F.regexp_replace(text, '^x(.*"tienda_id":"T01")', "$1")
    every = lambda text: F.regexp_replace(text, "^x", "")
    for n, mend in enumerate((one_store, one_store, every, every)):
        replay.replay(d.spark, landed, mended, f"{path}/control-{n}", mend, available_now=True).awaitTermination()
    return replay.mended_sales(d.spark, mended)
