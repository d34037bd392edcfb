"""Fingerprints: peeling against set differences, order and edits by brute force, corner cases."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from anaquel.llm import fingerprints as P
from tests.llm.conftest import prose


@pytest.mark.parametrize("only", [0, 1, 3, 10, 40, 300])
def test_difference_is_the_set_difference(only):
    rng = random.Random(only)
    both = [rng.getrandbits(64) for _ in range(200)]
    a = both + [rng.getrandbits(64) for _ in range(only)]
    b = both + [rng.getrandbits(64) for _ in range(only // 2)]
    gone, new = P.difference(a, b)
    assert sorted(gone) == sorted(set(a) - set(b)) and sorted(new) == sorted(set(b) - set(a))


def test_small_sketches_fail_and_larger_ones_do_not():
    rng = random.Random(2)
    a = [rng.getrandbits(64) for _ in range(100)]
    assert P.peel(P.sketch(a), P.sketch([])) is None
    assert sorted(P.peel(P.sketch(a, 128), P.sketch([], 128))[0]) == sorted(a)


def test_fingerprint_reads_back_and_shows_equal_texts():
    own = P.digests(prose(1, 300))
    assert P.parse(str(P.sketch(own))) == P.sketch(own)
    assert str(P.sketch(own)) == str(P.sketch(P.digests(prose(1, 300))))
    assert str(P.sketch(own)) != str(P.sketch(own[1:]))


def test_repeated_paragraphs_have_digests_of_their_own():
    assert len(set(P.digests("same\nsame\n\n same \nother"))) == 4


def test_cuts_of_long_lines_are_local():
    sentences = [f"{prose(i, 8)}." for i in range(60)]
    a = P.paragraphs(" ".join(sentences))
    b = P.paragraphs(" ".join(["New start."] + sentences))
    assert len(a) > 10 and len(set(a) - set(b)) <= 1
    assert " ".join(a) == " ".join(sentences)


def brute(rows):
    """Rows in their order; near values from multisets of paragraphs."""
    out = []
    like = lambda a, b: (
        2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values())) if a or b else 1.0)
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        n = len(text) // 3
        edited = text[:len(text) - n] + following[:n]
        bags = [Counter(P.paragraphs(t)) for t in (text, edited, following)]
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
            round(like(bags[0], bags[1]), 9), round(like(bags[0], bags[2]), 9),
        ))
    return sorted(out, key=repr)


def ours(docs):
    return sorted(
        ((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))
         for r in P.fingerprints_of_edits(docs).collect()), key=repr)


def test_matches_brute_force_over_many_ranges(docs_of, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_BYTES", 2000)
    rows = [(i * 37 % 401 - 100, "\n".join(prose(i + j, 6) for j in range(i % 9))) for i in range(200)]
    rows += [(10_000 + i, rows[i][1]) for i in range(3)]
    docs = docs_of(rows).repartition(6)
    assert ours(docs) == brute(sorted(rows, reverse=True))


def test_one_document_follows_itself(docs_of):
    assert ours(docs_of([(1, "abcdef")])) == brute([(1, "abcdef")])


def test_odd_rows(odd_docs, with_clashes):
    rows = P.fingerprints_of_edits(with_clashes(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r.n_chars for r in rows) == sorted(len(r.text or "") for r in odd_docs.collect())
    assert all(0.0 <= v <= 1.0 for r in rows for v in (r.near_edited, r.near_next))
    prints = {}
    for r, text in ((r, t.text or "") for r in rows for t in odd_docs.collect() if t.doc_id == r.doc_id):
        if len(text) == r.n_chars:
            prints.setdefault(text, set()).add(r.fingerprint)
    assert len(prints[""]) == 1


def test_empty_table(docs_of):
    assert ours(docs_of([])) == []
