"""Batch sinks."""

from __future__ import annotations

from hashlib import sha1

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.settings import SERIE, SERIE_DIA


def save(df: DataFrame, path: str) -> None:
    """Overwrite a Parquet table."""
    df.write.mode("overwrite").parquet(path)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a Parquet table and return the frame that reads it."""
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_by_series(df: DataFrame, path: str, buckets: int) -> DataFrame:
    """Overwrite a Parquet table bucketed by (tienda_id, sku) and return the frame that reads it.

    Readers that work by series (trailing windows, per-series aggregates) then start without a
    shuffle. Buckets need a catalog entry; it is named after the path and only points to the files.
    """
    spark = df.sparkSession
    name = series_table(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.write.mode("overwrite")
        .bucketBy(buckets, *SERIE)
        .sortBy(*SERIE_DIA)
        .option("path", path)
        .saveAsTable(name, format="parquet")
    )
    return spark.table(name)


def series_table(path: str) -> str:
    """The catalog name of a table by series."""
    return "anaquel_" + sha1(path.encode()).hexdigest()


def save_partitioned(df: DataFrame, path: str, column: str = "horizonte") -> DataFrame:
    """Overwrite a Parquet table with one folder per value of ``column``; return its reader."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)
    return df.sparkSession.read.parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Write CSV part files in the frame's own order."""
    df.write.mode("overwrite").csv(path, header=True)


def save_json(df: DataFrame, path: str) -> None:
    """Overwrite a JSON snapshot, one document per line."""
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def append_manifest(loads: DataFrame, path: str) -> None:
    """Append one JSON line per accepted load (fecha, origen, fichero, registros)."""
    loads.select(
        F.col("fecha").cast("string"), "origen", "fichero", F.col("registros").cast("bigint")
    ).write.mode("append").json(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table or model that no longer holds, wherever Spark can write."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
