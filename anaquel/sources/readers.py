"""Batch sources: every reader declares its schema, so no pass is spent on inference."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from anaquel import schemas
from anaquel.settings import FACTOR_DIA, TIENDAS
from anaquel.sources.literals import local_frame


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Products of one or many ``{"products": [...]}`` documents."""
    return _documents(spark, path, schemas.CATALOGO, "products")


def read_index_series(spark: SparkSession, path: str) -> DataFrame:
    """Observations of one or many ``{"Data": [{FK_Periodo, Valor}]}`` documents."""
    return _documents(spark, path, schemas.SERIE_INDICE, "Data")


def read_month_factors(spark: SparkSession, path: str) -> DataFrame:
    """A ``{"1": f, ..., "12": f}`` document as rows (mes, factor)."""
    text = spark.read.text(path, wholetext=True)
    return text.select(
        F.explode(F.from_json("value", "map<string,double>")).alias("mes", "factor")
    ).select(F.expr("try_cast(mes AS int)").alias("mes"), "factor")


def stores(spark: SparkSession) -> DataFrame:
    """The fixed list of stores."""
    return local_frame(spark, TIENDAS, schemas.TIENDA)


def weekday_factors(spark: SparkSession) -> DataFrame:
    """Weekday factors keyed like ``dayofweek``: Sunday is 1, Monday 2."""
    rows = [((monday_based + 1) % 7 + 1, f) for monday_based, f in enumerate(FACTOR_DIA)]
    return local_frame(spark, rows, schemas.FACTOR_DIA)


def read_sales_history(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.VENTA)


ILEGIBLE = "linea ilegible"


def read_sales_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Sales of a CSV feed, and the lines that are none: ``fichero, linea, motivo``.

    A line with a wrong number of fields, or with a field that is not of its column's type, is kept
    with its whole text instead of turning into NULLs that pass for missing values. Every data line is in exactly
    one of the two frames, so their counts add up to the lines read.
    """
    return _checked(spark, path, schemas.VENTA)


def read_inventory_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The same for an inventory feed."""
    return _checked(spark, path, schemas.INVENTARIO)


def _checked(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    shape = StructType([*schema.fields]).add("_corrupta", "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupta"}
    header = ",".join(schema.fieldNames())
    lines = (
        spark.read.text(path).select("value", F.col("_metadata.file_name").alias("fichero"))
        .where((F.col("value") != header) & (F.col("value") != ""))
        .withColumn("v", F.from_csv("value", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shape), options))
    )
    broken = F.col("v").isNull() | F.col("v._corrupta").isNotNull()
    good = lines.where(~broken).select(*(F.col(f"v.{c}").alias(c) for c in schema.fieldNames()))
    return good, lines.where(broken).select(
        "fichero", F.col("value").alias("linea"), F.lit(ILEGIBLE).alias("motivo")
    )


def read_inventory_history(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.INVENTARIO)


def read_inventory_live(spark: SparkSession, path: str) -> DataFrame:
    """Today's inventory, or no rows while the file does not exist."""
    return _or_empty(spark, schemas.INVENTARIO, lambda: _csv(spark, path, schemas.INVENTARIO))


def read_stream_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed stream files, or no rows before the first batch.

    ``parquet`` is what ``anaquel.streaming`` lands (accepted rows are kept, quarantined ones are
    pruned as a partition); ``csv`` reads plain one-file-per-batch folders.
    """

    def parquet() -> DataFrame:
        landed = spark.read.schema(schemas.VENTA_LANDED).parquet(path)
        return landed.where("estado = 'ok'").drop("estado")

    def csv() -> DataFrame:
        return _csv(spark, path, schemas.VENTA_STREAM, pathGlobFilter="*.csv")

    return _or_empty(spark, schemas.VENTA_STREAM, {"parquet": parquet, "csv": csv}[fmt])


def read_probability(spark: SparkSession, path: str) -> DataFrame:
    """Stock-out probabilities, or no rows if no model has been trained yet."""
    return _or_empty(
        spark,
        schemas.PROBABILIDAD,
        lambda: spark.read.schema(schemas.PROBABILIDAD).parquet(path),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CARGA).json(path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """A gold table; partition folders come back as columns."""
    return spark.read.parquet(path)


def _documents(spark: SparkSession, path: str, schema: StructType, array: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True).select(F.inline(array))


def _csv(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    """CSV whose header must name the schema's columns in their order; another header is an error."""
    return spark.read.schema(schema).options(**options).csv(path, header=True, enforceSchema=False)


def _or_empty(spark: SparkSession, schema: StructType, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return local_frame(spark, [], schema)
