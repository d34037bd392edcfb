"""Importance resampling towards a target distribution.

A document's weight is the mean log-likelihood ratio of its hashed features between a target corpus and the
documents, looked up in one array of gains. Its score adds Gumbel noise made from its doc_id, so the highest scores are a
weighted sample without replacement. The lowest score drawn is found by a distributed quickselect; only
the winners are sorted.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from anaquel.llm.common import ship, stored, text_key

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
PIECE = 1 << 18  # bytes of a text taken at once
PIVOTS = 32  # pivot keys of one round
COPIES = 4096  # rows unfolded from one element

_INSIDE = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
#: Lower-cases A-Z and turns every byte that is no part of a word into a space.
_WORDS = bytes(c if c in _INSIDE else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def feature_buckets(text: bytes, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """Words and buckets of the features (words, pairs of neighbours) of a text, piece by piece."""
    at, last = 0, None
    while at < len(text):
        gap = _GAP.search(text, at + PIECE)
        stop = gap.start() if gap else len(text)
        words = text[at:stop].translate(_WORDS).split()
        at = stop
        if not words:
            continue
        single = list(map(crc32, words))
        # The checksum of "a b" goes on from that of "a".
        spaced = list(map(crc32, repeat(b" "), single))
        if last is None:
            pairs = map(crc32, words[1:], spaced)
        else:
            pairs = map(crc32, words, [last, *spaced])
        last = spaced[-1]
        yield len(words), np.array([*single, *pairs], np.int64) % buckets


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket; each task sends one row per bucket at most."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.large_binary()):
                for _, found in feature_buckets(text.as_py() or b"", buckets):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counted = docs.select("text").mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        out[row.bucket] = row.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket 1000 times the log ratio of the smoothed shares in target and raw, rounded down."""
    n, all_raw, all_target = len(raw), float(raw.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (all_raw + n) / ((s + 1) * (all_target + n))))
        for s, t in zip(raw.astype(float).tolist(), target.astype(float).tolist())
    ], np.int64)


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, text_hash, n_words, n_features, weight`` of every row; whole texts, null like empty."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(gain)  # 8 bytes per bucket

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            rows = []
            for text in batch.column(2).cast(pa.large_binary()):
                n_words = n_features = total = 0
                for n, found in feature_buckets(text.as_py() or b"", len(gain)):
                    n_words += n
                    n_features += len(found)
                    total += int(gain[found].sum())
                rows.append((n_words, n_features, total // n_features if n_features else 0))
            columns = np.array(rows, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, columns)], schema.names
            )

    rows = docs.select("doc_id", text_key("text").alias("text_hash"), "text")
    counts = [StructField(c, LongType(), False) for c in ("n_words", "n_features", "weight")]
    schema = StructType([rows.schema["doc_id"], rows.schema["text_hash"], *counts])
    return rows.mapInArrow(score, schema)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of the seed and the doc_id (``null`` where there is none)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def _key() -> Column:
    """The composite key: smaller is better. No two rows of the pool have the same."""
    return F.struct((-F.col("score")).alias("s"), F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")


def _key_of(row: Row, pool: DataFrame) -> Column:
    doc_id = F.lit(row.doc_id).cast(pool.schema["doc_id"].dataType)
    return F.struct(
        F.lit(-row.score).cast("long").alias("s"), F.lit(row.doc_id is None).alias("n"),
        doc_id.alias("doc_id"), F.lit(row.text_hash).cast("long").alias("text_hash"),
    )


def kth_key(pool: DataFrame, k: int, pivots: int = PIVOTS) -> tuple[Column, int]:
    """The key that the k-th best row of the pool has, and how many rows are better.

    Quickselect: some keys of those still open, picked by hash, part them; each part and each pivot is
    counted exactly, and only the part that holds the k-th goes on, in a table of its own. When no
    more keys are open than there are pivots, the k-th is one of them.
    """
    still, better, level = pool, 0, 0
    while True:
        chosen = (
            still.orderBy(F.xxhash64("doc_id", "text_hash", F.lit(level)), _key()).limit(pivots)
            .orderBy(_key()).collect()
        )
        keys = [_key_of(row, pool) for row in chosen]
        # Odd parts hold the rows that equal a pivot, even ones those between two.
        place = sum(((_key() >= p).cast("int") + (_key() > p).cast("int") for p in keys), F.lit(0))
        counted = still.groupBy(place.alias("part")).agg(F.sum("copies").alias("n")).collect()
        sizes = {row.part: row.n for row in counted}
        part = 0
        while better + sizes.get(part, 0) < k:
            better += sizes.get(part, 0)
            part += 1
        if part % 2:
            return keys[part // 2], better
        level += 1
        still = stored(still.where(place == part), "still_open")


def _unfolded(rows: DataFrame) -> DataFrame:
    """One row per copy, with its number from 1 on; a row that stands for very many is unfolded in parts."""
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long")))
    each = F.explode(F.sequence(F.col("from") + 1, F.least("copies", F.col("from") + COPIES)))
    return rows.withColumn("from", first).withColumn("copy", each)


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """``doc_id, text_hash, n_words, n_features, weight, score, rank`` of every row of ``docs``.

    Of the N rows with at least ``min_words`` words, ``percent`` of a hundred (rounded down) with the highest scores
    are drawn and ranked from 1; ties go to the smaller doc_id (null last), then by the text's hash.
    The others' rank is null. Null and empty texts have no features and weight 0. Rows equal in doc_id and text
    have ranks that follow each other. An empty ``docs`` gives no rows, an empty ``target`` counts as one
    without features. Other columns are not read.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = stored(
        weights(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored"
    )
    out = ["doc_id", "text_hash", "n_words", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    short = scored.where(F.col("n_words") < min_words).select(*out, unranked)
    # Copies of a row become one before anything is sorted.
    pool = stored(
        scored.where(F.col("n_words") >= min_words).groupBy(*out).agg(F.count("*").alias("copies")), "pool"
    )
    n = pool.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    k = percent * n // 100
    if not k:
        return short.union(_unfolded(pool).select(*out, unranked))
    last, better = kth_key(pool, k)
    losers = _unfolded(pool.where(_key() > last)).select(*out, unranked)
    drawn = F.when(_key() == last, F.lit(k - better)).otherwise(F.col("copies"))
    winners = pool.where(_key() <= last).withColumn("drawn", drawn)
    # Scores are whole numbers between the least and the greatest gain plus noise: about 90,000 at
    # most, whatever the corpus. So the ranks before each score are a small table, and a score's
    # own rows, a few in ten thousand, are ranked by themselves.
    before = winners.groupBy("score").agg(F.sum("drawn").alias("n")).select(
        "score", (F.sum("n").over(Window.orderBy(F.desc("score"))) - F.col("n")).alias("before")
    )
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "text_hash")
    running = F.sum("drawn").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranked = (
        winners.withColumn("ahead", F.coalesce(running, F.lit(0)))
        .join(F.broadcast(before), "score")
    )
    rank = F.when(F.col("copy") <= F.col("drawn"), F.col("before") + F.col("ahead") + F.col("copy"))
    return short.union(losers).union(_unfolded(ranked).select(*out, rank.alias("rank")))


def draw(docs: DataFrame, target: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` that ``resampled`` draws, whole and in no order; of copies as many as it draws."""
    ranked = resampled(docs, target, **options)
    keys = stored(
        ranked.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.count("rank").alias("_drawn"), F.count("*").alias("_copies")).where("_drawn > 0"), "drawn",
    )
    met = docs.join(keys, docs["doc_id"].eqNullSafe(keys["_id"]) & (text_key(docs["text"]) == keys["_hash"]))
    own = [docs[c] for c in docs.columns]
    whole = met.where(keys["_drawn"] == keys["_copies"]).select(*own)
    cut = keys.where("_drawn < _copies").first()  # only the last key drawn can be cut
    return whole if cut is None else whole.union(
        met.where(keys["_drawn"] < keys["_copies"]).select(*own).limit(cut["_drawn"])
    )
