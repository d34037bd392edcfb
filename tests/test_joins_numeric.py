from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from anaquel.functions import joins
from anaquel.functions.numeric import rnd
from tests.conftest import rows


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_equals_broadcast_lookup(spark, how):
    fact = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),
        F.col("id").alias("v"),
    )
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("doble"))
    small = joins.lookup(fact, dim, ["k"], ["doble"], how)
    large = joins.lookup(fact, dim, ["k"], ["doble"], how, max_bytes=10)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    assert large.columns == small.columns
    assert sorted(map(str, rows(small))) == sorted(map(str, rows(large)))


def test_copies_of_one_row_are_spread_over_tasks(spark):
    """A key that holds a third of all rows, all of them equal, does not end in one task."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        hot = F.col("id") % 3 == 0
        fact = spark.range(0, 90_000, 1, 12).select(
            F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
            F.when(hot, F.lit("the same text in every copy of the row")).otherwise(F.col("id").cast("string")).alias("v"),
        )
        dim = fact.select("k").distinct().withColumn("x", F.lit(1))
        joined = joins.lookup(fact, dim, ["k"], ["x"], max_bytes=10)
        per_task = joined.groupBy(F.spark_partition_id().alias("t")).agg(
            F.sum((F.col("k") == "hot").cast("int")).alias("n")
        )
        tasks = [r for r in rows(per_task) if r[1]]
        plan = per_task._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "skew=true" in plan
    assert sum(n for _, n in tasks) == 30_000
    assert len(tasks) > 3


def test_rounding_of_what_is_no_number_is_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1e21,), (-1e30,), (2.5,)], ["x"])
    assert [r[0] for r in rows(df.select(rnd("x", 0)))] == [None, None, None, None, 3.0]


def test_size_is_measured_from_the_values(spark):
    text = spark.createDataFrame([("abc", 12), ("ñ", None)], "a string, b int")
    assert joins.measured_bytes(text) == (3 + 2 + 2 + 0) + 4 * 16
    assert joins.fits(text, 71)
    assert not joins.fits(text, 70)
    assert joins.fits(text.where("1 = 0"), 0)


def test_rounding_is_half_up_and_ignores_float_noise(spark):
    df = spark.createDataFrame([(9508.845,), (1.005,), (-1.005,), (0.1 + 0.2,)], ["x"])
    assert [r[0] for r in rows(df.select(rnd("x", 2)))] == [9508.85, 1.01, -1.01, 0.3]
