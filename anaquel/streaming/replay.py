"""Batches of a stream landed in folders of their own, and quarantined messages sent back once mended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from anaquel import schemas
from anaquel.streaming.ingest import ACEPTADA, CUARENTENA, parse_sales

LUGAR = ["particion", "offset_kafka"]
#: The stream's id, which Spark keeps in its checkpoint and sets while a batch runs.
_STREAM_ID = "sql.streaming.queryId"


def land_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    seconds: int = 60,
    available_now: bool = False,
    prepare: Callable[[DataFrame, str, int], DataFrame] | None = None,
) -> StreamingQuery:
    """Write every batch to ``path/ejecucion=<stream>/lote=<batch>``, replacing what an attempt before left there.

    A batch that runs again writes its own folder again, so the table is the same after any number of
    attempts; a stream with a new checkpoint has folders of its own. ``prepare`` sees (batch, stream, number) first.
    """

    def write(batch: DataFrame, number: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty(_STREAM_ID)
        if prepare is not None:
            batch = prepare(batch, run, number)
        batch.write.mode("overwrite").parquet(f"{path}/ejecucion={run}/lote={number}")

    trigger = {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}
    return (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(**trigger).foreachBatch(write).start()
    )


def drain(query: StreamingQuery) -> None:
    """Let a continuous stream take in all there is, then stop it.

    Unlike ``available_now`` over a log, which ends with the batch that holds the last message, this also runs the
    batch without messages that sends what the watermark has passed by then.
    """
    query.processAllAvailable()
    query.stop()


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """All landed batches with columns ``ejecucion`` and ``lote``; no rows before the first."""
    full = f"{schema if isinstance(schema, str) else schema.simpleString()[7:-1].replace(':', ' ')}"
    typed = spark.createDataFrame([], f"{full}, ejecucion string, lote long").schema
    try:
        return spark.read.schema(typed).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], typed)


def replay(
    spark: SparkSession,
    landed: str,
    mended: str,
    checkpoint: str,
    mend: Callable[[Column], Column],
    seconds: int = 60,
    available_now: bool = False,
) -> StreamingQuery:
    """Send the quarantined messages of ``landed`` through ``mend`` and the parser; what passes goes to ``mended``.

    A message is known by its place in the log and keeps its time of arrival. One that an earlier batch, another stream or an
    earlier ``mend`` has already sent back is left out, so replaying again, also with a new checkpoint, adds nothing;
    a better ``mend`` (with a new checkpoint) sends back only what is still open. Messages that still do not
    parse stay where they are.
    """
    texts = spark.readStream.schema(schemas.MENSAJE).parquet(landed).where(F.col("estado") == CUARENTENA)
    sales = parse_sales(
        texts.select(
            mend(F.col("mensaje")).alias("value"),
            F.col("particion").alias("partition"),
            F.col("offset_kafka").alias("offset"),
            "recibido",
        ),
        arrival=F.col("recibido"),
    )
    good = sales.where(F.col("estado") == ACEPTADA).drop("estado", "mensaje")

    def unsent(batch: DataFrame, run: str, number: int) -> DataFrame:
        own = (F.col("ejecucion") == run) & (F.col("lote") == number)
        return _without(batch, read_batches(spark, mended, schemas.VENTA_STREAM).where(~own))

    return land_batches(good, mended, checkpoint, "append", seconds, available_now, unsent)


def mended_sales(spark: SparkSession, mended: str) -> DataFrame:
    """Sales sent back from quarantine, in the columns of landed sales."""
    return read_batches(spark, mended, schemas.VENTA_STREAM).drop("ejecucion", "lote")


def still_open(quarantined: DataFrame, sent_back: DataFrame) -> DataFrame:
    """Quarantined messages that no replay has sent back."""
    return _without(quarantined, sent_back)


def _without(messages: DataFrame, sent: DataFrame) -> DataFrame:
    """Rows whose place is not among ``sent``; places may lack either part."""
    places = sent.select(*(F.col(c).alias(f"_{c}") for c in LUGAR))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LUGAR]
    return messages.join(places, same[0] & same[1], "left_anti")
