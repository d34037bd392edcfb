"""Weighted random forest on the feature rows: training, metrics and scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel import schemas
from anaquel.functions.numeric import rnd
from anaquel.operators.features import (
    confusion,
    hit_rates,
    rule_warns,
    split,
    split_summary,
    weighted,
)
from anaquel.operators.ranks import exact_auc
from anaquel.session import series_partitions
from anaquel.settings import SERIE, SERIE_DIA, VARIABLES, Params
from anaquel.sources.literals import local_frame

_DRAWS = 1 << 20


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metrics: DataFrame
    importance: DataFrame


def train(features: DataFrame, params: Params = Params()) -> Trained | None:
    """Fit and test the classifier; ``None`` if there is no label or only one class.

    ``features`` should be a stored table, since training and testing both read it.
    """
    spark = features.sparkSession
    facts = split_summary(features, params).first()
    if facts is None or not facts.entrenable:
        return None

    train_rows, test_rows = split(features, F.lit(facts.corte), params)
    if params.filas_entrenamiento:
        share = min(1.0, params.filas_entrenamiento / facts.entrenamiento)
        draw = F.pmod(F.xxhash64(*SERIE_DIA), F.lit(_DRAWS))
        train_rows = train_rows.where(draw < round(share * _DRAWS))
    model = _fit(weighted(train_rows, facts.peso_positivos), params)

    return Trained(
        model,
        _metrics(model.transform(test_rows), facts.peso_positivos),
        _importance(spark, model),
    )


def _fit(rows: DataFrame, params: Params) -> PipelineModel:
    """Index the category, assemble the vector and grow the weighted forest.

    The forest draws its samples by partition and position. Its input is therefore placed and
    ordered by series and day, which gives even partitions, the same trees for the same data
    whatever the cluster layout, and lets a lost task draw the same sample again. That one shuffle
    is kept for the several passes of the fit; the category index needs a single column and reads
    the table itself.
    """
    index = StringIndexer(
        inputCol="categoria", outputCol="_categoria", handleInvalid="keep"
    ).fit(rows.select("categoria"))
    assemble = VectorAssembler(
        inputCols=[*VARIABLES, "_categoria"], outputCol="features", handleInvalid="skip"
    )
    ordered = (
        rows.select(*SERIE_DIA, "categoria", *VARIABLES, "etiqueta", "peso")
        .repartition(series_partitions(rows.sparkSession), *SERIE_DIA)
        .sortWithinPartitions(*SERIE_DIA)
    )
    training = assemble.transform(index.transform(ordered)).select("features", "etiqueta", "peso")
    training.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        forest = RandomForestClassifier(
            labelCol="etiqueta",
            weightCol="peso",
            numTrees=params.arboles,
            maxDepth=params.profundidad,
            seed=params.semilla,
            cacheNodeIds=params.guardar_nodos,
            # A split can tell all categories and the one for unknown values apart.
            maxBins=max(32, len(index.labels) + 1),
        ).fit(training)
    finally:
        training.unpersist()
    return PipelineModel(stages=[index, assemble, forest])


def _metrics(scored: DataFrame, weight: float) -> DataFrame:
    """Quality of the scored test rows, which are kept for the two passes over them."""
    predictions = scored.select(
        "etiqueta", "prediction", vector_to_array("probability").getItem(1).alias("p"), "dias_cobertura", "lead_time"
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        auc = exact_auc(predictions, F.col("p"), F.col("etiqueta")).first().auc
        row = (
            predictions.agg(
                *confusion(F.col("prediction") == 1), *confusion(rule_warns(), "_regla")
            )
            .select(rnd(F.lit(auc).cast("double"), 4).alias("auc"), "*", *hit_rates(), *hit_rates("_regla"))
            .select(
                "auc", "precision", "recall", "precision_regla", "recall_regla",
                "vp", "fp", "fn", "vn",
                rnd(F.lit(weight), 2).alias("peso_positivos"),
            )
        )
        return local_frame(scored.sparkSession, row.collect(), row.schema)
    finally:
        predictions.unpersist()


def _importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    names = [*VARIABLES, "categoria"]
    weights = model.stages[-1].featureImportances.toArray()
    return local_frame(
        spark, [(n, round(float(w), 4)) for n, w in zip(names, weights)], schemas.IMPORTANCIA
    )


def score(model: PipelineModel, features: DataFrame, day: Column) -> DataFrame:
    """Probability of a stock-out per series on the given day."""
    today = features.where(F.col("fecha") == day)
    probability = vector_to_array("probability").getItem(1)
    return model.transform(today).select(*SERIE, rnd(probability, 4).alias("probabilidad"))


def no_probability(spark: SparkSession) -> DataFrame:
    """The empty probability table that risk reads while no model exists."""
    return local_frame(spark, [], schemas.PROBABILIDAD)


def model_vs_rule(metrics: DataFrame) -> DataFrame:
    """How far the model is ahead of the rule."""
    return metrics.select(
        "recall",
        rnd(F.col("recall") - F.col("recall_regla"), 4).alias("recall_vs_regla"),
        "precision",
        rnd(F.col("precision") - F.col("precision_regla"), 4).alias("precision_vs_regla"),
    )
