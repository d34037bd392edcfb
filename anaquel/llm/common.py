"""Helpers shared by the operators: identity of rows, written intermediate tables, partition counts."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import anaquel

from anaquel.session import scratch_path

SPACE = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a batch of rows that is sent to a task's Python: executor and worker each hold a copy of it.
BATCH_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and go on from the files.

    What several later steps read is computed once, lineage ends here, and lost executors take
    nothing with them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column | str) -> Column:
    """Tells apart texts that share a doc_id; rows equal in both are the same document."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def parts_for(df: DataFrame, total_bytes: int, each: int) -> int:
    """Partitions of about ``each`` bytes, and not fewer than the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-total_bytes // each))


def text_bytes(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of a text column, summed where the rows are."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0]


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would.

    Batches for Python are bounded by their bytes as well: ten thousand rows of long texts are no bound.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_anaquel_shipped", False):
        return
    root = Path(anaquel.__file__).parent
    handle, path = tempfile.mkstemp(prefix="anaquel-", suffix=".zip")
    with os.fdopen(handle, "wb") as file, zipfile.ZipFile(file, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, str(Path("anaquel") / source.relative_to(root)))
    sc.addPyFile(path)
    sc._anaquel_shipped = True


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(task: Task) -> Task:
    """The same task, which at its end gives back the memory that allocators keep.

    Workers are used again and wait for their next task next to the executor's other work; what they hold while they
    wait counts against the executor.
    """

    def run(batches):
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return run
