"""The corpus pipeline: toxicity, line dedup, near-duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; ``run`` writes what a
stage returns to the shared folder and reads it back for the next. All stages but the last return the
columns of documents; the last adds size, source_size, target and taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from anaquel.llm import decontaminate, linededup, mixing, neardup, toxicity
from anaquel.llm.common import documents, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go from all but one of them."""
    return linededup.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal and similar texts stays."""
    return neardup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the words it takes of each."""
    return mixing.mixed_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: No SQL: classifier, sampling and alignment cannot be said in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
