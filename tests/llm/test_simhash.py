"""SimHash near-dedup against all pairs, and its parts."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from anaquel.llm import queries, simhash
from tests.llm.conftest import prose


def brute_print(text, size=4):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, distance=4):
    """Least position that links reach, for each position."""
    label = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= distance and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    groups = defaultdict(list)
    for root, (doc_id, _) in zip(brute_classes(prints), rows):
        groups[root].append(doc_id)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return sorted(
        ((d, f"{p:016x}", least[r]) for (d, _), p, r in zip(rows, prints, brute_classes(prints))), key=repr
    )


def ours(docs):
    got = simhash.near_duplicates(docs).withColumn("fingerprint", simhash.hexadecimal("fingerprint"))
    return sorted(map(tuple, got.collect()), key=repr)


def family(seed, words, copies):
    rng = random.Random(seed)
    base = prose(seed, words).split()
    for _ in range(copies):
        edited = list(base)
        for _ in range(rng.randint(0, 3)):
            edited[rng.randrange(len(edited))] = prose(rng.random(), 1)
        yield " ".join(edited)


def test_matches_brute_force(docs_of):
    texts = [t for s in range(6) for t in family(s, 150, 15)] + [prose(100 + s, 60) for s in range(40)]
    rows = [(900 - i, t) for i, t in enumerate(texts)]
    expected = brute(rows)
    assert ours(docs_of(rows)) == expected
    assert 40 < len({c for _, _, c in expected}) < len(rows)


def test_odd_rows(odd_docs, with_clashes):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert ours(with_clashes(odd_docs)) == brute(rows)
    zero = {f for d, f, _ in ours(odd_docs) if d in (1, 2, 3, 8)}
    assert zero == {"0" * 16}


def test_empty_table(docs_of):
    assert ours(docs_of([(1, "a")]).limit(0)) == []


def test_hash_is_that_of_the_engine(spark, docs_of):
    text = prose(5, 4)
    [[engine]] = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t")).collect()
    assert simhash.simhash(text.encode()) == engine % (1 << 64)


@pytest.mark.parametrize("piece", [1, 7, 64, 1000])
def test_pieces_do_not_matter(piece, monkeypatch):
    text = " \t" + prose(7, 300).replace(" ", " \n ") + "  "
    whole = simhash.simhash(text.encode())
    monkeypatch.setattr(simhash, "PIECE", piece)
    assert simhash.simhash(text.encode()) == whole == brute_print(text)


@pytest.mark.parametrize("agree", [1, 2, 3, 5])
def test_close_pairs_share_a_choice_of_blocks(agree):
    rng = random.Random(agree)
    masks = simhash.block_masks(4, agree)
    assert len(set(masks)) == len(masks)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << i for i in rng.sample(range(64), 4))
        assert any(a & m % (1 << 64) == b & m % (1 << 64) for m in masks)


def test_more_fingerprints_need_more_equal_blocks():
    assert [simhash.agreeing(n, 4) for n in (1, 1 << 12, 1 << 13, 1 << 21, 1 << 40)] == [1, 1, 2, 3, 5]


def test_spanning_links_connect_what_all_links_connect():
    rng = np.random.default_rng(3)
    for _ in range(30):
        base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
        flips = np.uint64(1) << rng.integers(0, 64, (60, 3)).astype(np.uint64)
        prints = np.unique(rng.choice(base, 60) ^ np.bitwise_xor.reduce(flips, axis=1))
        label = list(range(len(prints)))
        links = simhash.spanning_links(prints, 4)
        for i, j in links:
            assert int(prints[i] ^ prints[j]).bit_count() <= 4
            label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
        assert label == brute_classes([int(p) for p in prints])
        assert len(links) == len(prints) - len(set(label))


def test_crowded_blocks_are_dealt_out_without_losing_links(spark):
    """A chain through one hot group: each fingerprint links its neighbours only."""
    rng = random.Random(11)
    chain, bits = [0], list(range(64))
    for _ in range(120):
        chain.append(chain[-1] ^ sum(1 << b for b in rng.sample(bits[:40], 4)))
    prints = sorted(set(chain))
    signed = [((p ^ (1 << 63)) - (1 << 63),) for p in prints]
    found = simhash.links(spark.createDataFrame(signed, "fingerprint long"), slice_size=8).collect()
    place = {s[0]: i for i, s in enumerate(signed)}
    label = list(range(len(prints)))
    for a, b in found:
        assert ((a ^ b) % (1 << 64)).bit_count() <= 4
        i, j = place[a], place[b]
        label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    assert label == brute_classes(prints)


def test_query_over_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_simhash_neardup"](spark, sf)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
