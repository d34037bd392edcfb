"""Decontamination: planted passages, edits within and beyond the budget, alignment, corner cases."""

from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from anaquel.llm import decontaminate as D
from anaquel.llm import words as W
from tests.llm.conftest import CLASHING, prose


@pytest.fixture(scope="module")
def items():
    return [(i, prose(900 + i, 12 + 3 * i)) for i in range(20)]


@pytest.fixture(scope="module")
def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def change(text: str, edits: int, seed: int) -> str:
    rng = random.Random(seed)
    out = list(text)
    for _ in range(edits):
        i = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[i] = "#"
        elif kind == 1:
            out.insert(i, "#")
        else:
            del out[i]
    return "".join(out)


def pairs(docs, benchmark):
    return {(r.doc_id, r.item_id) for r in D.find_leaks(docs, benchmark).collect()}


def test_planted_passages_are_found_and_nothing_else(docs_of, benchmark, items):
    rows, expected = [], set()
    for i in range(60):
        parts = [prose(i, 80), prose(5000 + i, 80)]
        if i % 3 == 0:
            item, text = items[i % len(items)]
            parts.insert(1, text.upper() if i % 2 else text.replace(" ", "\n"))
            expected.add((i, item))
        rows.append((i, " ".join(parts)))
    assert pairs(docs_of(rows), benchmark) == expected


@pytest.mark.parametrize("seed", range(6))
def test_edits_within_the_budget_of_a_window_are_found(docs_of, benchmark, items, seed):
    rows, expected = [], set()
    for item, text in items:
        size = min(D.WINDOW, len(text))
        rows.append((item, f"{prose(seed, 30)} {change(text[:size], D.budget(size), seed)} {prose(item, 30)}"))
        expected.add((item, item))
    assert expected <= pairs(docs_of(rows), benchmark)


def test_edits_beyond_the_budget_are_not(docs_of, spark):
    text = prose(7, 12)
    far = "".join("#" if i % 9 == 0 else c for i, c in enumerate(text))
    assert len(text) < D.WINDOW
    assert not pairs(docs_of([(1, f"x {far} y")]), spark.createDataFrame([(1, text)], "item_id long, text string"))


def test_excerpts_of_a_long_item_are_found_wherever_they_are_cut(docs_of, spark):
    text = prose(31, 90)
    rows = [
        (at, f"{prose(at, 12)} #{text[at:at + size]}# {prose(900 + at, 12)}")
        for size, cuts in ((96, range(0, 240, 7)), (100, range(241, 330, 5))) for at in cuts
    ]
    got = D.find_leaks(docs_of(rows), spark.createDataFrame([(1, text)], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == [at for at, _ in rows] and {r.edits for r in got} == {0}
    edited = [(at, f"{prose(at, 12)} {change(text[at:at + 96], 5, at)} {prose(900 + at, 12)}") for at in range(0, 300, 11)]
    assert len(pairs(docs_of(edited), spark.createDataFrame([(1, text)], "item_id long, text string"))) == len(edited)


def test_short_items_are_found_whole(docs_of, spark):
    items = [(1, "Paris"), (2, "seven times six"), (3, "x²+1 = 0"), (4, "a"), (5, "paris"), (6, "")]
    rows = [
        (1, "in PARIS, then"), (2, "comparison"), (3, "Seven\ntimes six"), (4, "so x²+1 = 0"), (5, "seven times sixty"),
        (6, "parisa"), (7, "paris"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert pairs(docs_of(rows), benchmark) == {(1, 1), (1, 5), (3, 2), (4, 3), (7, 1), (7, 5)}


def edit_distance_in(pattern, text):
    """Least edits of the pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_alignment_matches_the_full_table():
    rng = random.Random(3)
    for _ in range(40):
        pattern = "".join(rng.choices("abc", k=rng.randint(30, 90)))
        known = D.index([(0, pattern)])
        k = int(known.edits[0])
        noisy = change(pattern, rng.randint(0, k), rng.random())
        lead = rng.randint(0, 30)
        text = "".join(rng.choices("abc", k=lead)) + noisy + "".join(rng.choices("abc", k=20))
        cost, _ = D.align(
            D.characters(text.encode()), known, np.array([0]), np.array([lead - max(k, 1)]),
            np.array([0]), np.array([len(text)]),
        )
        exact = edit_distance_in(pattern, text)
        if exact <= k:  # the band holds every match within the budget around the planted place
            assert exact <= cost[0] <= edit_distance_in(pattern, noisy)


def test_every_match_within_the_budget_is_a_candidate():
    rng = random.Random(4)
    for _ in range(30):
        pattern = prose(rng.random(), 14)[:90]
        known = D.index([(0, pattern)])
        text = f"{prose(1, 20)} {change(pattern, int(known.edits[0]), rng.random())} {prose(2, 20)}"
        points = D.characters(text.encode())
        window, _ = D.candidates(points, np.full(len(points), len(points)), known)
        assert 0 in window.tolist()


def test_place_and_edits(docs_of, benchmark, items):
    text = items[5][1]
    row = D.find_leaks(docs_of([(1, f"é漢 {text}")]), benchmark).collect()
    assert [(r.item_id, r.edits, r.start, r.stop) for r in row] == [(5, 0, 3, 3 + len(text))]


def test_long_texts_across_pieces(docs_of, benchmark, items, monkeypatch):
    long = prose(1, 200_000)
    cut = D.CHUNK - 40  # the passage lies across the border of two pieces
    rows = [(1, long[:cut] + " " + items[19][1] + " " + long[cut:]), (2, long)]
    assert pairs(docs_of(rows), benchmark) == {(1, 19)}


def test_benchmark_in_several_blocks(docs_of, benchmark, items, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_CHARS", 300)
    rows = [(i, f"{prose(i, 20)} {text}") for i, text in items]
    assert pairs(docs_of(rows), benchmark) == {(i, i) for i, _ in items}


def test_odd_rows(odd_docs, spark, with_clashes):
    items = [(1, None), (None, prose(2, 40)), (2, ""), (3, "short"), (4, prose(2, 40)), (4, prose(2, 40))]
    benchmark = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    got = D.find_leaks(with_clashes(odd_docs), benchmark).collect()
    assert sorted({(str(r.doc_id), str(r.item_id)) for r in got}) == [
        ("5", "4"), ("5", "None"), ("None", "4"), ("None", "None")
    ]


def test_stage_drops_rows_only(odd_docs, spark, with_clashes):
    benchmark = spark.createDataFrame([(4, prose(2, 40))], "item_id long, text string")
    docs = with_clashes(odd_docs)
    out = D.without_leaks(docs, benchmark)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(["1", "2", "3", "4", "6", "7", "7", "None", "8", "9"])
    assert all(r[c] == f"own {c}" for r in got for c in CLASHING)


def test_empty_tables(docs_of, benchmark):
    assert D.find_leaks(docs_of([]), benchmark).collect() == []
    assert D.find_leaks(docs_of([(1, prose(1, 50))]), benchmark.limit(0)).collect() == []
    assert D.without_leaks(docs_of([(1, "a")]), benchmark.limit(0)).count() == 1


@pytest.mark.parametrize("chunk", [40, 41, 64, 97, 150, 333, 1000])
def test_pieces_do_not_change_what_is_found(docs_of, spark, monkeypatch, chunk):
    """Also of short items, whose borders are seen over those of the pieces."""
    bench = spark.createDataFrame([(1, "cat dog"), (2, prose(50, 40))], "item_id long, text string")
    rows = [
        (1, "con" + "cat dog " * 3 + prose(1, 200)), (2, prose(2, 30) + " cat dog " + prose(3, 50)),
        (3, "concat dogs " * 40), (4, prose(4, 33) + prose(50, 40) + prose(5, 90)), (5, "cat dog"),
    ]
    known = D.index([(r.item_id, r.text) for r in bench.orderBy("item_id").collect()])

    def found():
        data = pa.array([t for _, t in rows], pa.large_string())
        raw, starts, ends = W.utf8(data)
        hits = list(D._search_block(raw, starts, ends, 0, len(rows), known, 110))
        return [tuple(map(int, r)) for r in zip(*D._by_item(*map(np.concatenate, zip(*hits))))]

    whole = found()
    assert {r[0] for r in whole} == {0, 1, 3, 4}
    monkeypatch.setattr(D, "CHUNK", chunk)
    assert found() == whole


def test_rules_and_indentation_cost_nothing_and_are_no_leak():
    """A megabyte of one character, or of few, against items that hold rules."""
    items = [(n, prose(n, 12) + " " + mark * 400 + " " + prose(n + 90, 30)) for n, mark in enumerate("=-*#" * 5)]
    known = D.index(items)
    began = time.time()
    for text in ("=" * (1 << 20), "-=" * (1 << 19), " \n" * (1 << 19)):
        points = D.characters(text.encode())
        item, *_ = D.shared(points, np.full(len(points), len(points)), known)
        assert len(item) == 0
    assert time.time() - began < 5
    # The words beside the rule are found, with the rule or without.
    text = "=" * 5000 + " " + items[0][1] + " " + "=" * 5000
    raw, starts, ends = W.utf8(pa.array([text], pa.large_string()))
    hits = list(D._search_block(raw, starts, ends, 0, 1, known, 110))
    owners = np.concatenate([h[1] for h in hits])
    assert set(owners.tolist()) == {0}


def test_different_counts_each_run():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 7, 60).astype(np.uint64)
    for width in (1, 5, 60):
        assert D.different(values, width).tolist() == [len(set(values[i:i + width])) for i in range(61 - width)]
