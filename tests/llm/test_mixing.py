"""Mixing: targets by hand and by repeated sharing, exact quotas, limits, repeatability."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from anaquel.llm import mixing
from tests.llm.conftest import CLASHING, prose


def shared(sizes: list[int]) -> list[float]:
    """Share all words by weight; what is above three times a size goes to the others, until none is."""
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    total, full = float(sum(sizes)), set()
    while True:
        rest = total - sum(3 * sizes[i] for i in full)
        open_ = sum(w for i, w in enumerate(weights) if i not in full)
        out = [3.0 * s if i in full else rest * weights[i] / open_ for i, s in enumerate(sizes)]
        above = {i for i, s in enumerate(sizes) if i not in full and out[i] >= 3 * s}
        if not above:
            return out
        full |= above


@pytest.mark.parametrize("sizes", [
    [100, 100, 100], [10, 1000, 5], [1, 1, 1, 1, 1, 5000], [0, 10, 7], [7], [3, 900, 900, 2, 2, 2, 800],
])
def test_targets(spark, sizes):
    rows = [(f"s{i:02}", s) for i, s in enumerate(sizes)]
    got = mixing.targets(spark.createDataFrame(rows, "source string, size long")).orderBy("source").collect()
    assert [r.target for r in got] == pytest.approx(shared(sizes))


def test_null_source_is_last_and_code_points_order(spark):
    rows = [(None, 100), ("é", 100), ("z", 100), ("A", 100)]
    got = {r.source: r.target for r in mixing.targets(
        spark.createDataFrame(rows, "source string, size long")).collect()}
    # A weighs 5, z 2, é 1, null 5; A and null stop at 300, which leaves nothing below 3 x for the rest
    assert got == dict(zip(["A", "z", "é", None], shared([100] * 4)))


@pytest.fixture(scope="module")
def corpus(docs_of):
    rows = [(i, prose(i, 5 + 37 * i % 400), "abc"[i % 3] if i % 5 else "hot") for i in range(300)]
    return docs_of(rows + [(300, None, "a"), (301, "", None), (302, prose(9, 50), None), (303, prose(8, 9), None)])


def test_taken_is_near_target_and_within_three_sizes(corpus):
    rows = mixing.mix(corpus).documents.collect()
    assert len(rows) == 304
    taken, goal = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        goal[r.source] = r.target
    for source, target in goal.items():
        assert abs(taken[source] - target) <= mixing.BLOCK_WORDS


def test_draws_are_disjoint_and_shards_even(corpus):
    mixed = mixing.mix(corpus, shards=8, block_words=16)
    draws = mixed.draws.collect()
    assert len({(r.doc_id, r.text_hash, r.copy, r.block, r["pass"]) for r in draws}) == len(draws)
    by_shard = [sum(r.shard == s for r in draws) for s in range(8)]
    assert max(by_shard) - min(by_shard) <= 1
    # The shards draw what the tree's quotas say, source by source.
    counted = {(r.source, r.shard): r["count"] for r in mixed.draws.groupBy("source", "shard").count().collect()}
    assert counted == {(r.source, r.shard): r.blocks for r in mixed.quotas.collect()}
    assert {r.doc_id: r.taken for r in mixed.documents.collect() if r.taken} == {
        r.doc_id: r.t for r in mixed.draws.groupBy("doc_id").agg(F.sum("words").alias("t")).collect()
    }


def test_same_again_in_other_partitions(corpus):
    first = {tuple(r) for r in mixing.mix(corpus).documents.collect()}
    assert first == {tuple(r) for r in mixing.mix(corpus.repartition(7)).documents.collect()}


def test_quotas_spread_like_hypergeometric_draws(spark, docs_of):
    """A source's share of a shard stays within five standard deviations of its share of all."""
    docs = docs_of([(i, prose(i, 64), "a" if i % 4 else "b") for i in range(2000)])
    quotas = mixing.mix(docs, shards=4).quotas.collect()
    total = sum(r.blocks for r in quotas)
    for source in "ab":
        own = sum(r.blocks for r in quotas if r.source == source)
        p, n = own / total, total / 4
        deviation = (n * p * (1 - p) * (total - n) / (total - 1)) ** 0.5
        for r in quotas:
            if r.source == source:
                assert abs(r.blocks - n * p) < 5 * deviation + 1


def test_odd_rows_and_repeats(odd_docs, with_clashes):
    rows = mixing.mix(with_clashes(odd_docs)).documents.collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    out = mixing.mixed_rows(with_clashes(odd_docs))
    # Columns with the names of the results give way, the others pass.
    assert [c for c in out.columns if c in ("size", "taken")] == ["size", "taken"]
    got = out.collect()
    assert all(r.taken > 0 for r in got)
    assert all(r[c] == f"own {c}" for r in got for c in CLASHING if c not in ("size", "taken"))
    assert sum(r.taken for r in got) == sum(r.taken for r in rows)


def test_empty_table(docs_of):
    mixed = mixing.mix(docs_of([]))
    assert mixed.documents.collect() == [] and mixed.draws.collect() == [] and mixed.quotas.collect() == []
    assert mixing.mixed_rows(docs_of([])).collect() == []


def test_shards_are_written(corpus, spark, tmp_path):
    mixed = mixing.mix(corpus, shards=4)
    mixing.write_shards(mixed, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == mixed.draws.count()


def test_what_is_taken_is_what_the_shards_draw(corpus):
    mixed = mixing.mix(corpus, shards=8)
    drawn = {}
    for r in mixed.draws.collect():
        words, shards = drawn.setdefault((r.doc_id, r.copy), [0, set()])
        drawn[r.doc_id, r.copy][0] += r.words
        shards.add(r.shard)
    for r in mixed.documents.collect():
        words, shards = drawn.get((r.doc_id, r.copy), (0, ()))
        assert (r.taken, r.shards) == (words, len(shards))
    blocks = {(r.source, r.shard): r.blocks for r in mixed.quotas.collect()}
    per_shard = {}
    for r in mixed.draws.collect():
        per_shard[r.source, r.shard] = per_shard.get((r.source, r.shard), 0) + 1
    assert per_shard == blocks


def test_rows_that_share_a_doc_id_are_dealt_apart(docs_of):
    """A third of all rows has no doc_id: their blocks lie all over the permutation."""
    rows = [(None if i % 3 else i, prose(i, 130)) for i in range(300)]
    keys = [r.order for r in mixing.mix(docs_of(rows)).draws.where("doc_id IS NULL").collect()]
    assert len(set(keys)) == len(keys)


def test_ranks_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_RANGES", 3)
    rows = spark.createDataFrame(
        [(("a", "b", None)[i % 3], i * 7919 % 1000, 1 + i % 5) for i in range(400)], "source string, k long, words long"
    )
    got = mixing._ranked(rows, ["source"], "k", ["words"], 17, words=True).collect()
    for source in ("a", "b", None):
        mine = sorted(((r.k, r.words, r._rank, r._before) for r in got if r.source == source))
        assert [r[2] for r in mine] == list(range(len(mine)))
        assert [r[3] for r in mine] == [sum(x[1] for x in mine[:i]) for i in range(len(mine))]
