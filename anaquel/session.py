"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from anaquel.sources.writers import materialise, materialise_by_series


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options that the plans are written for."""
    conf = {
        # Day boundaries and text timestamps are UTC.
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Joins on (tienda_id, sku, fecha) may use a partitioning by (tienda_id, sku), so the
        # dense fact, its windows and its aggregates share one placement of the series.
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        # Tables stored by series hold one sorted file per bucket; windows then skip their sort.
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
        # Streaming dedupe state goes to disk, not to the executor heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # Deliveries of one sale are settled in the map task before they are shuffled.
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    return spark


# A cell of the dense fact in memory, and what a partition or bucket of cells should hold.
BYTES_POR_CELDA = 64
SERIES_TARGET_BYTES = 256 * 1024 * 1024
_SERIES = "anaquel.series.partitions"


def size_series(spark: SparkSession, days: int, stores: int, products: int) -> int:
    """Set the partitions of series-keyed frames from the number of cells they unfold to.

    Called once the calendar and the dimensions are stored; all series tables that are written after it
    share the number, and a bucketed table carries it in its own definition.
    """
    cells = days * stores * products
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-cells * BYTES_POR_CELDA // SERIES_TARGET_BYTES))
    spark.conf.set(_SERIES, str(parts))
    return parts


def series_partitions(spark: SparkSession) -> int:
    """Partitions for series-keyed frames, as ``size_series`` set them.

    A fixed number on purpose: the frame is a few bytes per series when it is shuffled and grows
    by the number of days afterwards, so coalescing by shuffled size would starve the next stage.
    """
    return int(spark.conf.get(_SERIES, spark.conf.get("spark.sql.shuffle.partitions")))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one only when local."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="anaquel-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in this application's own part of it."""
    return f"{_scratch_root(spark)}/{uuid.uuid4().hex}/{name}"


_cleared: Counter[str] = Counter()


def scratch_generation(spark: SparkSession) -> int:
    """How often the scratch space has been cleared: frames of an earlier generation can't be read."""
    return _cleared[spark.sparkContext.applicationId]


def _scratch_root(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/anaquel/{app}/{scratch_generation(spark)}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch tables; what keeps frames of them asks ``scratch_generation``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
    _cleared[spark.sparkContext.applicationId] += 1


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and continue from the files.

    Cuts lineage, survives lost executors, and keeps column pruning for the readers.
    """
    return materialise(df, scratch_path(df.sparkSession, name))


def stage_by_series(df: DataFrame, name: str) -> DataFrame:
    """Like ``stage``, for day-by-series tables: stored so that work by series needs no shuffle."""
    spark = df.sparkSession
    return materialise_by_series(df, scratch_path(spark, name), series_partitions(spark))
