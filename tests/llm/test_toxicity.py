"""The classifier chain on planted words: held-out accuracy, the chain's use, corner cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from anaquel.llm import toxicity as T
from tests.llm.conftest import CLASHING, prose

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark, docs_of):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(900):
        words = prose(i, rng.randint(10, 120)).split()
        toxic, junk = i % 6 == 0, i % 6 == 1
        if toxic:
            for _ in range(rng.randint(1, 3)):  # whole words, and words with a tell-tale beginning
                words.insert(rng.randrange(len(words)), rng.choice(["nasty", "Vile!", f"krkozq{prose(rng.random(), 1)}"]))
        text = " ".join(words)
        texts.append((i, "!!! ".join(words).upper() if junk else text))
        if i % 3 != 2 or i < 300:
            labels.append((i, int(not junk), int(toxic)))
    return docs_of(texts), spark.createDataFrame(labels, LABELS)


@pytest.fixture(scope="module")
def scored(corpus):
    return {r.doc_id: r for r in T.classify(*corpus).collect()}


def test_held_out_documents(scored):
    held = [r for i, r in scored.items() if i % 3 == 2 and i >= 300]
    held += [r for i, r in scored.items() if i % 3 != 2]
    assert len(held) > 600
    wrong = [r.doc_id for r in held if r.toxic != (r.doc_id % 6 == 0)]
    assert len(wrong) <= 0.01 * len(held)
    assert all((r.p_low_quality > 0.5) == (r.doc_id % 6 == 1) for r in held if r.doc_id % 6 in (1, 3))


def test_one_word_in_a_long_text_is_caught(corpus):
    docs, labels = corpus
    chain = T.train(docs, T.label_categories(labels), ["low_quality", "toxic"])
    long = prose(77, 4000)
    rows = docs.sparkSession.createDataFrame([(1, long), (2, f"{long} nasty {long}")], "doc_id long, text string")
    got = {r.doc_id: r.p_toxic for r in T.predict(rows, chain).collect()}
    assert got[2] > 0.5 > got[1]


def test_later_models_see_earlier_probabilities(spark, docs_of):
    """The second category depends on the first one only, so the chain must carry it over."""
    docs = docs_of([(i, f"{prose(i, 20)} {'alpha' if i % 2 else 'beta'}") for i in range(400)])
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(400)], "doc_id long, a int, b int")
    chain = T.train(docs, labels, ["a", "b"])
    assert chain.before[1, 0] > 0.5 and chain.before[0].tolist() == [0.0, 0.0]


def test_training_rows_are_bounded_and_repeatable(corpus):
    docs, labels = corpus
    first = T.training_rows(docs, T.label_categories(labels), ["low_quality", "toxic"], 50)
    again = T.training_rows(docs.repartition(5), T.label_categories(labels), ["low_quality", "toxic"], 50)
    ids = sorted(r.doc_id for r in first.collect())
    assert len(ids) == 50 and ids == sorted(r.doc_id for r in again.collect())


def test_probabilities_do_not_depend_on_the_block():
    chain = T.Chain(["x"], np.random.default_rng(1).normal(size=(1, 1 << T.BITS)).astype(np.float32),
                    np.zeros((1, 1)), np.zeros(1))
    from anaquel.llm import words as W
    import pyarrow as pa

    raw, starts, ends = W.utf8(pa.array([prose(i, i) for i in range(30)] + [None, ""]))
    together = chain.probabilities(*T.features(raw, starts, ends, 0, 32), 32)
    alone = [chain.probabilities(*T.features(raw, starts, ends, i, i + 1), 1)[0, 0] for i in range(32)]
    assert np.allclose(together[:, 0], alone)


def test_odd_rows(corpus, odd_docs, with_clashes):
    _, labels = corpus
    odd = labels.union(labels.sparkSession.createDataFrame(
        [(None, 1, 1), (5, None, 1), (5, 1, None), (5, 1, 0), (5, 1, 0), (99999, 1, 1)], LABELS))
    out = T.without_toxic(with_clashes(odd_docs), odd)
    assert out.columns == with_clashes(odd_docs).columns
    got = out.collect()
    assert all(r[c] == f"own {c}" for r in got for c in CLASHING)
    scores = T.classify(with_clashes(odd_docs), odd).collect()
    assert len(scores) == odd_docs.count()
    assert all(0.0 <= r.p_toxic <= 1.0 for r in scores)
    assert len(got) == sum(not r.toxic for r in scores)


@pytest.mark.parametrize("rows", [[], [(1, 1, 0), (2, 1, 0)], [(1, 1, 1), (2, 1, 0)]])
def test_few_labels(spark, docs_of, rows):
    docs = docs_of([(1, prose(1, 20)), (2, prose(2, 20))])
    got = T.classify(docs, spark.createDataFrame(rows, LABELS)).collect()
    assert len(got) == 2 and all(np.isfinite(r.p_toxic) for r in got)
    if not rows or not any(r[2] for r in rows):
        assert not any(r.toxic for r in got)


def test_empty_table(spark, docs_of, corpus):
    _, labels = corpus
    assert T.classify(docs_of([]), labels).collect() == []
    assert T.without_toxic(docs_of([]), labels).collect() == []


def test_stage_drops_what_is_called_toxic(corpus, scored):
    docs, labels = corpus
    left = {r.doc_id for r in T.without_toxic(docs, labels).select(F.col("doc_id")).collect()}
    assert left == {i for i, r in scored.items() if not r.toxic}


def test_conflicting_labels_are_taken_together(spark, docs_of):
    docs = docs_of([(1, prose(1, 20)), (2, prose(2, 20)), (3, None)])
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (2, 0, 0), (2, 0, 0), (3, 1, None)], "doc_id long, a int, b int")
    for rows in (labels, labels.orderBy(F.desc("a")).repartition(3)):
        got = T.training_rows(docs, rows, ["a", "b"], 10).collect()
        assert sorted((r.doc_id, r.a, r.b) for r in got) == [(1, 1.0, 1.0), (2, 0.0, 0.0)]


def test_held_out_counts(spark, corpus):
    docs, labels = corpus
    odd = labels.union(spark.createDataFrame([(None, 1, 1), (99999, 1, 1)], LABELS))
    got = {r.threshold: r for r in T.held_out(docs, T.label_categories(odd), ["low_quality", "toxic"], [0.0, 0.4, 1.1]).collect()}
    n, toxic = got[0.0].documents, got[0.0].hits
    assert 200 < n < labels.count() and 0 < toxic < n and got[0.0].misses == 0 and got[0.0].false_alarms == n - toxic
    assert got[0.4].hits + got[0.4].misses == toxic and got[0.4].precision > 0.95 and got[0.4].recall > 0.95
    assert (got[1.1].hits, got[1.1].misses, got[1.1].precision, got[1.1].recall) == (0, toxic, None, 0.0)
