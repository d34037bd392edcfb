"""Near-duplicates: classes against all pairs, sampling against exact similarity, corner cases."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from anaquel.llm import neardup
from anaquel.llm import words as W
from anaquel.llm.common import BATCH_BYTES, lean
from tests.llm.conftest import CLASHING, prose


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else prose(rng.random(), 1) for w in text.split(" "))


def brute(rows, threshold=0.8):
    """class_id by doc_id, from all pairs of texts; each text has a doc_id of its own."""
    bags = {}
    for doc_id, text in rows:
        words = (text or "").split()
        n = min(5, len(words))
        bags[doc_id] = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else Counter()
    df = Counter(s for bag in bags.values() for s in bag)
    least = max(2.0, neardup.RARE * len(rows))
    idf = {s: math.log1p(len(rows) / max(n, least)) for s, n in df.items()}
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    texts = dict(rows)
    ids = sorted(root)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            low = sum(min(n, bags[b][s]) * idf[s] for s, n in bags[a].items() if s in bags[b])
            high = sum(n * idf[s] for bag in (bags[a], bags[b]) for s, n in bag.items()) - low
            same = (texts[a] or "") == (texts[b] or "")
            if same or high and low / high >= threshold:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def ours(docs):
    return {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}


def test_classes_match_all_pairs(docs_of):
    rows, at = [], 0
    for family in range(12):
        base = prose(family, 40 + 30 * family)
        for member in range(family % 5 + 1):
            rows.append((at * 11 % 97, edited(base, at, 0.004 * member)))
            at += 1
    rows += [(200 + i, prose(500 + i, 3)) for i in range(4)] + [(300, rows[3][1]), (301, rows[3][1])]
    expected = brute(rows)
    assert ours(docs_of(rows)) == expected
    assert 12 < len(set(expected.values())) < len(rows)


def test_star_leader_does_not_hide_links(docs_of):
    """Copies that are each near the original but not near each other still make one class."""
    base = prose(1, 400)
    rows = [(50, base)] + [(i, edited(base, i, 0.006)) for i in range(30)]
    expected = brute(rows)
    assert ours(docs_of(rows)) == expected
    assert len(set(expected.values())) < 8


def test_chain_is_one_component(docs_of):
    words = prose(1, 200).split()
    rows = [(i, " ".join(words[6 * i:6 * i + 100])) for i in range(15)]
    assert ours(docs_of(rows)) == brute(rows)


@pytest.mark.parametrize("share", [0.01, 0.03, 0.08])
def test_samples_agree_as_often_as_weighted_jaccard_says(share):
    a = prose(1, 600)
    b = edited(a, 2, share)
    raw, starts, ends = W.utf8(pa.array([a, b]))
    codes, times, edges = neardup.block_shingles(raw, starts, ends, 0, 2)
    weights = (1 + (codes % np.uint64(5))).astype(np.float32) * times.astype(np.float32)
    exact = neardup.similarity(
        (codes[:edges[1]], weights[:edges[1]]), (codes[edges[1]:], weights[edges[1]:])
    )
    draws = 3000
    log = np.log(weights)
    agree = sum(
        int(s[0] == s[1]) for s in (neardup.samples(codes, log, edges[:-1], k) for k in range(draws))
    )
    assert abs(agree / draws - exact) < 5 * math.sqrt(exact * (1 - exact) / draws) + 0.005


def test_block_does_not_show_in_codes():
    texts = [prose(i, 30) for i in range(40)]
    raw, starts, ends = W.utf8(pa.array(texts))
    codes, _, edges = neardup.block_shingles(raw, starts, ends, 0, 40)
    for i in (0, 7, 39):
        alone, _, _ = neardup.block_shingles(raw, starts, ends, i, i + 1)
        assert np.array_equal(np.sort(alone), np.sort(codes[edges[i]:edges[i + 1]]))


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (10, 11), (12, 11), (20, 21)] + [(30 + i, 31 + i) for i in range(40)]
    got = {r.node: r.root for r in neardup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[n] for n in (2, 3, 9)} == {1} and got[11] == got[12] == 10 and got[21] == 20
    assert {got[n] for n in range(31, 71)} == {30}


def test_odd_rows(odd_docs, with_clashes):
    rows = neardup.near_duplicates(with_clashes(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    classes = {}
    for r in rows:
        classes.setdefault(r.doc_id, set()).add(r.class_id)
    assert classes[None] == {None}
    assert classes[1] == classes[2] == {1}  # null and empty are equal texts
    assert classes[5] == {5} and classes[4] == {4} and classes[6] == {6}


def test_keep_one(docs_of, with_clashes):
    base = prose(1, 300)
    rows = [(4, base), (2, edited(base, 1, 0.003)), (9, base), (7, prose(2, 50)), (7, prose(2, 50)), (None, base)]
    docs = with_clashes(docs_of(rows))
    out = neardup.keep_one(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted(str(r.doc_id) for r in got) == ["2", "7", "None"]
    assert all(r[c] == f"own {c}" for r in got for c in CLASHING)


def test_empty_table(docs_of):
    assert neardup.near_duplicates(docs_of([])).collect() == []
    assert neardup.keep_one(docs_of([])).collect() == []


def test_blocks_give_the_same_similarities(monkeypatch):
    monkeypatch.setattr(neardup, "SLAB", 7)
    rng = np.random.default_rng(0)
    codes = [np.unique(rng.integers(0, 40, rng.integers(0, 30)).astype(np.uint64)) for _ in range(9)]
    weights = [c.astype(float) + 1 for c in codes]
    got = neardup.similarities(codes, weights, 4)
    for i in range(4):
        for j in range(5):
            exact = neardup.similarity((codes[i], weights[i]), (codes[4 + j], weights[4 + j]))
            assert abs(got[i, j] - exact) < 1e-9


def test_python_batches_are_bounded_by_bytes(spark, docs_of):
    """Ten thousand rows of 20 kB are no bound on what a task's Python holds."""
    docs = docs_of([(n, "word " * 4000) for n in range(1000)])
    neardup.near_duplicates(docs).count()

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    most = docs.coalesce(1).select("text").mapInArrow(sizes, "bytes long").agg({"bytes": "max"}).first()[0]
    assert most <= 2 * BATCH_BYTES


def test_document_frequencies_count_each_document_once(spark, docs_of):
    docs = docs_of([(1, "a b c d e"), (2, "a b c d e"), (3, "a b c d e f"), (4, None), (5, "a b c d e a b c d e")])
    sketch, n = neardup.document_frequencies(docs)
    assert n == 5 and sketch.max() == 4 and sketch.sum() == 1 + 1 + 2 + 5


def test_a_lean_task_passes_on_its_batches():
    batch = pa.RecordBatch.from_pydict({"x": [1, 2]})
    assert list(lean(lambda batches: (b for b in batches))(iter([batch, batch]))) == [batch, batch]
