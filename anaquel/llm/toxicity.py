"""Toxicity by a classifier chain over hashed words and word beginnings.

The categories form a chain: the model of each sees, besides the text's features, the probabilities of
the categories before it. Those are out-of-fold in training, so that a model learns from probabilities
as good as it will get later. Models are logistic regressions over the features that chi-square picks.

Training uses at most ``MAX_TRAINING`` labelled documents, drawn by a hash of doc_id; every document is
scored, over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.llm import words as W
from anaquel.llm.common import lean, ship, stored

MAX_TRAINING = 20_000
FOLDS = 3
THRESHOLD = 0.4
MAX_ITERATIONS = 20  # ends early on purpose: 100 found fewer toxic texts among held-out ones
TOLERANCE = 1e-4
REGULARISATION = 1e-3
BITS = 18
PREFIXES = (4, 5, 6)  # bytes of a word's beginning
MIN_CHI2 = 30.0  # by chance one in 20 million features gets there
MAX_FEATURES = 1024  # per category
_BASE = 0xA0761D6478BD642F

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_NO_LETTER = np.ones(256, dtype=bool)
_NO_LETTER[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False
_NO_SIGN = ~_NO_LETTER
_NO_SIGN[[0x20, *range(0x09, 0x0E)]] = True


def _ids(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (W.mix(hashes + np.uint64(kind * _BASE % (1 << 64))) >> np.uint64(64 - BITS)).astype(np.int64)


def features(raw, starts, ends, row: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of row and feature, sorted, each once: words in lower case, their beginnings, runs of signs,
    and the text's shape (shares of capitals, signs and distinct words, in tenths)."""
    a, z = int(starts[row]), int(ends[stop - 1])
    text = _LOWER[raw[a:z]]
    begin, end = starts[row:stop] - a, ends[row:stop] - a
    first, last = W.word_spans(text, 0, len(text), begin, _NO_LETTER)
    sign_first, sign_last = W.word_spans(text, 0, len(text), begin, _NO_SIGN)
    runs = sign_last - sign_first > 1

    def owner(at):
        return np.searchsorted(begin, at, side="right") - 1

    whole = W.span_hashes(text, first, last)
    of_word = owner(first)
    owners, ids = [of_word], [_ids(whole, 0)]
    for n in PREFIXES:
        longer = last - first > n
        owners.append(of_word[longer])
        ids.append(_ids(W.span_hashes(text, first[longer], first[longer] + n), n))
    owners.append(owner(sign_first[runs]))
    ids.append(_ids(W.span_hashes(text, sign_first[runs], sign_last[runs]), 1))

    n_texts = stop - row
    texts = np.arange(n_texts)
    size = np.maximum(end - begin, 1)
    capital = np.flatnonzero(raw[a:z] != text)
    capitals = np.searchsorted(capital, end) - np.searchsorted(capital, begin)
    signs = np.bincount(owner(sign_first), weights=sign_last - sign_first, minlength=n_texts)
    n_words = np.bincount(of_word, minlength=n_texts)
    pairs = np.unique((of_word.astype(np.uint64) << np.uint64(40)) | (whole >> np.uint64(24)))
    different = np.bincount((pairs >> np.uint64(40)).astype(np.int64), minlength=n_texts)
    shapes = (10 * capitals // size, (10 * signs / size).astype(np.int64), 10 * different // np.maximum(n_words, 1))
    for kind, shape in enumerate(shapes):
        owners.append(texts)
        ids.append(_ids(np.asarray(shape, dtype=np.uint64), 10 + kind))
    packed = np.unique((np.concatenate(owners) << BITS) | np.concatenate(ids))
    return packed >> BITS, packed & ((1 << BITS) - 1)


def _sparse(batches: Iterator[pa.RecordBatch]):
    """Features of labelled texts, as strings for the vectoriser."""
    for batch in batches:
        raw, starts, ends = W.utf8(batch.column("text"))
        for row, stop in W.blocks(starts, ends):
            owner, ids = features(raw, starts, ends, row, stop)
            edges = np.searchsorted(owner, np.arange(stop - row + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(ids).cast(pa.string()))
            part = batch.slice(row, stop - row)
            yield pa.RecordBatch.from_pydict({
                **{n: part.column(n) for n in part.schema.names if n != "text"}, "features": lists,
            })


@dataclass
class Chain:
    """For each category: weights by feature, of the categories before it, and the intercept."""

    categories: list[str]
    weights: np.ndarray  # categories x 2**BITS
    before: np.ndarray  # categories x categories
    intercept: np.ndarray

    def probabilities(self, owner: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
        """Texts x categories, from pairs of text and feature."""
        used = np.flatnonzero(np.any(self.weights[:, ids] != 0, axis=0))
        owner, ids = owner[used], ids[used]
        out = np.zeros((n, len(self.categories)))
        for c in range(len(self.categories)):
            score = np.bincount(owner, weights=self.weights[c, ids], minlength=n)
            score = score + self.intercept[c] + out[:, :c] @ self.before[c, :c]
            out[:, c] = 1.0 / (1.0 + np.exp(-np.clip(score, -500, 500)))
        return out


def training_rows(docs: DataFrame, labels: DataFrame, categories: list[str], limit: int) -> DataFrame:
    """doc_id, fold, the categories and the features of at most ``limit`` labelled documents.

    A document labelled more than once is in a category if any of its labels says so.
    """
    known = labels.where(F.expr(" AND ".join(["doc_id IS NOT NULL", *[f"`{c}` IS NOT NULL" for c in categories]])))
    drawn = (
        known.groupBy("doc_id").agg(*[F.max(F.col(c).cast("double")).alias(c) for c in categories])
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
        .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    )
    drawn = stored(drawn, "drawn")  # at most ``limit`` rows of a few numbers: small enough to broadcast
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, fold int, " + "".join(f"`{c}` double, " for c in categories) + "features array<string>"
    rows = (
        texts.join(F.broadcast(drawn), "doc_id")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "fold", *categories, "text")
        .mapInArrow(lean(_sparse), schema)
    )
    return stored(rows, "training")


def selected(rows: DataFrame, categories: list[str]) -> list[str]:
    """The features whose presence depends most on a category, by chi-square; at most ``MAX_FEATURES`` for each."""
    totals = rows.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    counts = rows.select(F.explode("features").alias("feature"), *categories).groupBy("feature").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]
    )
    chosen: set[str] = set()
    for c in categories:
        total, positive = float(totals["n"]), float(totals[c] or 0.0)
        if not 0.0 < positive < total:
            continue
        both, present = F.col(c), F.col("n")
        determinant = both * F.lit(total) - present * F.lit(positive)
        spread = present * (F.lit(total) - present) * F.lit(positive * (total - positive))
        chi2 = F.try_divide(F.lit(total) * determinant * determinant, spread.cast("double"))
        best = (
            counts.select("feature", chi2.alias("chi2")).where(F.col("chi2") >= MIN_CHI2)
            .orderBy(F.desc("chi2"), "feature").limit(MAX_FEATURES)
        )
        chosen.update(r["feature"] for r in best.collect())
    return sorted(chosen, key=int)


def train(
    docs: DataFrame, labels: DataFrame, categories: list[str], limit: int = MAX_TRAINING
) -> Chain:
    """Train the chain in the order of ``categories`` (0/1 columns of ``labels``).

    A category whose sample has one class only, or no rows, gets that class' constant probability.
    """
    spark = docs.sparkSession
    n = len(categories)
    chain = Chain(
        list(categories), np.zeros((n, 1 << BITS), dtype=np.float32), np.zeros((n, n)), np.full(n, -500.0)
    )
    rows = training_rows(docs, labels, categories, limit)
    vocabulary = selected(rows, categories)
    if vocabulary:
        model = CountVectorizerModel.from_vocabulary(vocabulary, "features", "words")
        model.setBinary(True)
        table = model.transform(rows).drop("features")
    else:
        table = rows.drop("features")
    table = stored(table, "vectors")
    sizes = {
        (r["fold"], c): (r["n"], r[c]) for r in
        table.groupBy("fold").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).collect()
        for c in categories
    }

    def fit(data: DataFrame, c: int, counts: list[tuple]):
        total, positive = sum(t for t, _ in counts), sum(p for _, p in counts)
        if not total or not 0 < positive < total or not vocabulary:
            return None, 500.0 if total and positive == total else (
                -500.0 if not positive else float(np.log(positive / (total - positive)))
            )
        return LogisticRegression(
            featuresCol="input", labelCol=categories[c], maxIter=MAX_ITERATIONS, regParam=REGULARISATION,
            tol=TOLERANCE, probabilityCol="probability",
        ).fit(data), 0.0

    def predict(model, constant, data: DataFrame, name: str) -> DataFrame:
        if model is None:
            return data.withColumn(name, F.lit(1.0 / (1.0 + float(np.exp(-constant)))))
        scored = model.transform(data)
        return scored.withColumn(name, vector_to_array("probability")[1]).drop(
            "probability", "rawPrediction", "prediction"
        )

    for c, category in enumerate(categories):
        earlier = [f"p_{e}" for e in categories[:c]]
        inputs = (["words"] if vocabulary else []) + earlier
        data = table if not vocabulary else VectorAssembler(
            inputCols=inputs, outputCol="input"
        ).transform(table)
        everything = [sizes[k] for k in sizes if k[1] == category]
        model, constant = fit(data, c, everything)
        chain.intercept[c] = constant if model is None else model.intercept
        if model is not None:
            coefficients = model.coefficients.toArray()
            chain.weights[c, [int(v) for v in vocabulary]] = coefficients[: len(vocabulary)]
            chain.before[c, :c] = coefficients[len(vocabulary):]
        if c + 1 < n:
            parts = None
            for fold in range(FOLDS):
                others = [sizes[k] for k in sizes if k[1] == category and k[0] != fold]
                held = data.where(F.col("fold") == fold)
                part = predict(*fit(data.where(F.col("fold") != fold), c, others), held, f"p_{category}")
                parts = part if parts is None else parts.union(part)
            table = stored(parts.drop("input"), "out_of_fold")
    return chain


def _score(chain):
    def score(batches):
        model = chain.value
        for batch in batches:
            raw, starts, ends = W.utf8(batch.column("text"))
            parts = [
                model.probabilities(*features(raw, starts, ends, row, stop), stop - row)
                for row, stop in W.blocks(starts, ends)
            ]
            out = np.concatenate(parts) if parts else np.zeros((0, len(model.categories)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in batch.schema.names if n != "text"),
                 *(pa.array(out[:, c]) for c in range(out.shape[1]))],
                names=[*(n for n in batch.schema.names if n != "text"), *(f"p_{c}" for c in model.categories)],
            )

    return score


def predict(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id`` and the probability ``p_<category>`` of each category, for every row.

    A null or empty text has no words and gets what the models say to that. Rows are scored one by one,
    repeated ones alike; a null doc_id passes. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(chain)  # 1 MB per category
    schema = "doc_id long, " + ", ".join(f"`p_{c}` double" for c in chain.categories)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).mapInArrow(lean(_score(model)), schema)


def label_categories(labels: DataFrame) -> DataFrame:
    """The two categories that the label table holds: junk (quality 0) and toxic."""
    return labels.select(
        "doc_id", (1 - F.col("quality")).alias("low_quality"), F.col("toxic").alias("toxic")
    )


def held_out(
    docs: DataFrame, labels: DataFrame, categories: list[str], thresholds: list[float], limit: int = MAX_TRAINING
) -> DataFrame:
    """How the last category does on labels its chain has not seen: a row per threshold.

    Half of the labelled documents, by a hash of doc_id, train a chain; the others are scored. Columns:
    ``threshold, documents, hits, false_alarms, misses, precision, recall``; the last two are null where nothing
    is found or nothing is to be found. Labels of one document are taken together, as in training; those of
    documents that are not there, or with a null, do not count.
    """
    target = F.col(categories[-1])
    half = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(2))
    chain = train(docs, labels.where(half == 0), categories, limit)
    truth = labels.where((half == 1) & target.isNotNull()).groupBy("doc_id").agg((F.max(target) > 0).alias("truth"))
    scored = predict(docs, chain).select("doc_id", F.col(f"p_{categories[-1]}").alias("p")).join(truth, "doc_id")
    each = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold")
    called = F.col("p") >= F.col("threshold")
    counts = scored.select("truth", "p", each).groupBy("threshold").agg(
        F.count("*").alias("documents"), F.count_if(called & F.col("truth")).alias("hits"),
        F.count_if(called & ~F.col("truth")).alias("false_alarms"), F.count_if(~called & F.col("truth")).alias("misses"),
    )
    hits = F.col("hits")
    return counts.withColumns({
        "precision": F.try_divide(hits, hits + F.col("false_alarms")), "recall": F.try_divide(hits, hits + F.col("misses")),
    })


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, p_low_quality, p_toxic, toxic`` for every row; toxic from ``threshold`` on."""
    ship(docs.sparkSession)
    chain = train(docs, label_categories(labels), ["low_quality", "toxic"])
    return predict(docs, chain).withColumn("toxic", F.col("p_toxic") >= threshold)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the chain does not call toxic, with their columns as they are."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(
        train(docs, label_categories(labels), ["low_quality", "toxic"])
    )
    at = docs.columns.index("text")

    def keep(batches):
        chain = model.value
        for batch in batches:
            raw, starts, ends = W.utf8(batch.column(at))
            stays = [
                chain.probabilities(*features(raw, starts, ends, row, stop), stop - row)[:, -1] < threshold
                for row, stop in W.blocks(starts, ends)
            ]
            if stays:
                yield batch.filter(pa.array(np.concatenate(stays)))

    return docs.mapInArrow(lean(keep), docs.schema)
