"""Substring dedup against a plain Python version, and its corner cases."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from anaquel.llm import substrings
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """doc_id, n_words, n_removed, kept of texts that each have a doc_id of their own."""
    seen, out = set(), []
    for doc_id, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                gone[i:i + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), kept))
    return out


def ours(docs):
    got = substrings.drop_repeated_passages(docs).select("doc_id", "n_words", "n_removed", "kept").collect()
    return sorted(map(tuple, got), key=repr)


def test_matches_brute_force(docs_of):
    rng = random.Random(5)
    passages = [prose(100 + i, rng.choice([19, 20, 21, 35, 60])) for i in range(12)]
    rows = []
    for i in range(150):
        parts = [prose(i, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), prose(1000 * i + rng.randint(0, 9), rng.randint(0, 25))]
        rows.append((i * 7 % 150, rng.choice([" ", "\n", "  \t"]).join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(5)]  # whole copies
    expected = brute(rows)
    assert ours(docs_of(rows)) == sorted(expected, key=repr)
    assert sum(r[2] for r in expected) > 1000


def test_repeats_inside_a_text(docs_of):
    one = prose(1, 30)
    rows = [(1, " ".join([one, prose(2, 5), one])), (2, " ".join(["la"] * 100)), (3, "la " * 20)]
    assert ours(docs_of(rows)) == sorted(brute(rows), key=repr)


def test_one_phrase_in_many_contexts(docs_of):
    phrase = prose(1, 12)
    rows = [(i, f"{prose(10 + i, 15)} {phrase} {prose(500 + i, 15)}") for i in range(80)]
    assert ours(docs_of(rows)) == sorted(brute(rows), key=repr)


def test_spans_name_an_earlier_source(docs_of):
    passage = prose(1, 50)
    rows = [(3, f"{prose(2, 10)} {passage}"), (8, f"{passage} {prose(3, 10)}"), (9, prose(4, 40))]
    spans = {r.doc_id: r.spans for r in substrings.drop_repeated_passages(docs_of(rows)).collect()}
    assert [tuple(s) for s in spans[8]] == [(0, 50, 3, 10)] and not spans[3] and not spans[9]


def test_compaction_breaks_where_sources_part():
    spans = substrings.compact(
        np.array([4, 5, 6, 9, 10], np.uint32), np.array([1, 1, 2, 2, 2]), np.array([0, 1, 7, 3, 4], np.uint32)
    )
    assert spans.tolist() == [[4, 21, 1, 0], [6, 20, 2, 7], [9, 21, 2, 3]]


def test_odd_rows(odd_docs, with_clashes):
    got = ours(with_clashes(odd_docs))
    assert len(got) == odd_docs.count()
    # No text repeats another: rows equal in doc_id and text are one document, rows without doc_id none.
    for doc_id, n_words, n_removed, kept in got:
        assert n_removed == 0 and len(WORD.findall(kept)) == n_words
    assert sum(1 for r in got if r[0] in (1, 2, 3, 8) and r[1:] == (0, 0, "")) == 4


@pytest.mark.parametrize("partitions", [1, 2])
def test_repeated_rows_are_one_document(docs_of, partitions):
    passage = prose(1, 60)
    rows = [(1, prose(2, 40)), (4, passage), (4, passage), (6, f"{passage} {prose(3, 9)}"), (6, f"{passage} {prose(3, 9)}")]
    docs = docs_of(rows).repartition(partitions)
    assert ours(docs) == sorted([
        (1, 40, 0, prose(2, 40)), (4, 60, 0, passage), (4, 60, 0, passage),
        (6, 69, 60, prose(3, 9)), (6, 69, 60, prose(3, 9)),
    ], key=repr)
    spans = [r.spans for r in substrings.drop_repeated_passages(docs).where("doc_id = 6").collect()]
    assert [[tuple(s) for s in found] for found in spans] == [[(0, 60, 4, 0)]] * 2


def test_very_long_copy(docs_of):
    text = prose(1, 50_000)
    got = ours(docs_of([(1, text), (2, text)]))
    assert got == [(1, 50_000, 0, text), (2, 50_000, 50_000, "")]


def test_empty_table(docs_of):
    assert ours(docs_of([])) == []
