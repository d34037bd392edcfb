"""Small fixed frames held in the plan itself, so that Spark knows their size."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """A handful of rows as a local relation, or no rows at all, which the optimizer removes."""
    if not rows:
        nothing = spark.range(1).where(F.lit(False))
        return nothing.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
    named = [dict(zip(schema.fieldNames(), row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(named), schema)
