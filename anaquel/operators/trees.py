"""Decision trees as a table: one row per node, scored by joins, level by level.

A model stored this way can be read, checked and applied by anything that reads tables. Columns: ``arbol,
nodo`` (root 0), ``variable`` (position in the vector; NULL at a leaf), ``umbral`` (to the left up to it) or ``categorias`` (to the left
if in it), ``izquierda, derecha`` (children), ``p`` (a leaf's share of the positive class).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.functions.joins import lookup
from anaquel.functions.numeric import rnd
from anaquel.settings import SERIE_DIA, VARIABLES

NODO = (
    "arbol int, nodo int, variable int, umbral double, categorias array<double>, izquierda int, derecha int, p double"
)


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of the forest in a saved model, read from its own files."""
    node = F.col("nodeData")
    split, leaf = node["split"], node["leftChild"] < 0
    continuous = split["numCategories"] < 0
    values = split["leftCategoriesOrThreshold"]
    stats = node["impurityStats"]
    return spark.read.parquet(f"{path}/stages/2_*/data").select(
        F.col("treeID").alias("arbol"), node["id"].alias("nodo"),
        F.when(~leaf, split["featureIndex"]).alias("variable"),
        F.when(~leaf & continuous, F.get(values, F.lit(0))).alias("umbral"),
        F.when(~leaf & ~continuous, values).alias("categorias"),
        F.when(~leaf, node["leftChild"]).alias("izquierda"),
        F.when(~leaf, node["rightChild"]).alias("derecha"),
        F.when(leaf, F.try_divide(F.get(stats, F.lit(1)), F.get(stats, F.lit(0)) + F.get(stats, F.lit(1)))).alias("p"),
    )


def category_index(spark: SparkSession, path: str) -> DataFrame:
    """``categoria, indice`` of a saved model; unknown categories come after the last."""
    labels = spark.read.parquet(f"{path}/stages/0_*/data").select(F.get("labelsArray", F.lit(0)).alias("l"))
    return labels.select(F.posexplode("l").alias("indice", "categoria")).select(
        "categoria", F.col("indice").cast("double").alias("indice")
    )


def stump_nodes(train: DataFrame, variables: tuple[str, ...] = VARIABLES) -> DataFrame:
    """A table of trees of one split per variable, at its mean; a plain model to hold the forest against.

    A side that no row falls on has the share of all rows.
    """
    means = train.agg(*(rnd(F.avg(v), 6).alias(v) for v in variables)).first()
    positive = F.avg(F.col("etiqueta").cast("double"))

    def share(side: Column) -> Column:
        return rnd(F.coalesce(F.avg(F.when(side, F.col("etiqueta").cast("double"))), positive), 6)

    nodes = []
    for i, v in enumerate(variables):
        low = F.col(v) <= F.lit(means[v])
        tree, none = F.lit(i), F.lit(None).cast("int")
        no_cut, no_set = F.lit(None).cast("double"), F.lit(None).cast("array<double>")
        nodes += [
            F.struct(tree, F.lit(0), F.lit(i), F.lit(means[v]).cast("double"), no_set, F.lit(1), F.lit(2), no_cut),
            F.struct(tree, F.lit(1), none, no_cut, no_set, none, none, share(low)),
            F.struct(tree, F.lit(2), none, no_cut, no_set, none, none, share(~low)),
        ]
    shape = ", ".join(c.replace(" ", ": ", 1) for c in NODO.split(", "))
    named = F.array(*(n.cast(f"struct<{shape}>") for n in nodes))
    return train.agg(named.alias("n")).select(F.inline("n"))


def score_nodes(rows: DataFrame, nodes: DataFrame, vector: Column, depth: int, keys: list[str] = SERIE_DIA) -> DataFrame:
    """``keys, probabilidad``: the mean of the trees' leaves for each row, rounded to 6 decimals.

    Every row stands at the root of every tree; ``depth`` times, the node it stands at is looked up and it goes on to a
    child, unless it stands at a leaf. Nodes are broadcast while they are few, as a forest's are;
    rows stay where they are, so rows placed by ``keys`` are averaged without a shuffle. ``keys`` name
    a row. A row without a value where a tree asks for it goes right; ``nodes`` should be stored.
    """
    trees = [r.arbol for r in nodes.select("arbol").distinct().orderBy("arbol").collect()]
    inner = nodes.where("variable IS NOT NULL")
    step = [c for c in inner.columns if c not in ("arbol", "nodo", "p")]
    at = rows.select(*keys, vector.cast("array<double>").alias("_x")).withColumns({
        "arbol": F.explode(F.array(*(F.lit(t) for t in trees)).cast("array<int>")), "nodo": F.lit(0),
    })
    value = F.get("_x", F.col("variable"))
    left = F.coalesce(
        F.when(F.col("umbral").isNotNull(), value <= F.col("umbral")).otherwise(F.array_contains("categorias", value)),
        F.lit(False),
    )
    child = F.when(F.col("variable").isNull(), F.col("nodo")).when(left, F.col("izquierda")).otherwise(F.col("derecha"))
    for _ in range(depth):
        met = lookup(at, inner, ["arbol", "nodo"], step, "left")
        at = met.select(*keys, "_x", "arbol", child.alias("nodo"))
    leaves = nodes.where("variable IS NULL")
    return (
        lookup(at.drop("_x"), leaves, ["arbol", "nodo"], ["p"])
        .groupBy(*keys).agg(rnd(F.avg("p"), 6).alias("probabilidad"))
    )


def vector_of(variables: tuple[str, ...] = VARIABLES) -> Column:
    return F.array(*(F.col(v).cast("double") for v in variables))


def score_saved(spark: SparkSession, path: str, features: DataFrame, depth: int) -> DataFrame:
    """The saved forest's probabilities, by joins: what ``model.score`` says, without the model's own code."""
    index = category_index(spark, path)
    unknown = index.agg(F.count("*").cast("double")).scalar()
    rows = lookup(features, index, ["categoria"], ["indice"], "left").withColumn(
        "indice", F.coalesce("indice", unknown)
    )
    return score_nodes(rows, forest_nodes(spark, path), vector_of((*VARIABLES, "indice")), depth)
