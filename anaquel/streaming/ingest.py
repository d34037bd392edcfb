"""Continuous ingest of JSON sales with exactly-once landing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from anaquel import schemas

ACEPTADA = "ok"
CUARENTENA = "cuarentena"


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str = "ventas",
    group: str = "quiebres",
    **options: str,
) -> DataFrame:
    """Messages of a topic from the earliest offset on (columns value, partition, offset).

    ``minPartitions`` in ``options`` splits a busy topic partition over several tasks.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("groupIdPrefix", group)
        .options(**options)
        .load()
        .select("value", "partition", "offset")
    )


def parse_sales(messages: DataFrame, arrival: Column | None = None) -> DataFrame:
    """Messages (value, partition, offset) as sales with their origin and arrival time.

    ``arrival`` is the time of arrival where the messages carry one, such as a log's timestamp; where it is
    missing, it is now.

    A message that does not parse is kept with ``estado = 'cuarentena'`` and its raw text, so
    one bad message neither stops the query nor disappears.
    """
    shape = StructType([*schemas.VENTA.fields]).add("_corrupta", "string")
    raw, now = F.col("value").cast("string"), F.current_timestamp()
    parsed = messages.select(
        raw.alias("mensaje"),
        F.from_json(
            raw, shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupta"}
        ).alias("v"),
        F.col("partition").cast("int").alias("particion"),
        F.col("offset").cast("bigint").alias("offset_kafka"),
        (now if arrival is None else F.coalesce(arrival, now)).alias("recibido"),
    )
    good = F.col("v").isNotNull() & F.col("v._corrupta").isNull()
    return parsed.select(
        *(F.col(f"v.{c}").alias(c) for c in schemas.VENTA.fieldNames()),
        "particion",
        "offset_kafka",
        "recibido",
        F.when(good, ACEPTADA).otherwise(CUARENTENA).alias("estado"),
        F.when(~good, F.col("mensaje")).alias("mensaje"),
    )


def dedupe_deliveries(sales: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeated deliveries of a sale that arrive within ``delay`` of each other.

    Only accepted sales with an id can be copies of each other; any other message counts as itself,
    by its place in the log. The watermark runs on the time of arrival, so no sale is late, however
    old it is. State is bounded by it, and the batch layer's deduplication stays the authority.
    """
    itself = F.concat_ws(":", F.lit("#"), "particion", "offset_kafka")
    known = (F.col("estado") == ACEPTADA) & F.col("venta_id").isNotNull()
    return (
        sales.withColumn("_clave", F.when(known, F.concat(F.lit("="), "venta_id")).otherwise(itself))
        .withWatermark("recibido", delay)
        .dropDuplicatesWithinWatermark(["_clave"])
        .drop("_clave")
    )


def land(
    sales: DataFrame,
    path: str,
    checkpoint: str,
    seconds: int = 60,
    available_now: bool = False,
) -> StreamingQuery:
    """Append sales to a Parquet folder every ``seconds``; the commit log makes it exactly once."""
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}
    return (
        sales.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("estado")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """Raw text and origin of the messages that did not parse."""
    landed = spark.read.schema(schemas.MENSAJE).parquet(path)
    return landed.where(F.col("estado") == CUARENTENA).drop("estado")
