"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint's 64 bits are cut into ``distance + agree`` blocks. Two fingerprints that differ in at most
``distance`` bits differ in at most that many blocks, so they are equal in some ``agree`` of them: for each
choice of that many blocks fingerprints are joined on those bits, and the Hamming distance of what meets is
verified. ``agree`` only decides how many fingerprints meet by chance, never which links are found; it is
chosen from the number of different fingerprints.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from anaquel.functions.joins import lookup
from anaquel.llm.common import ship, stored
from anaquel.llm.neardup import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
PIECE = 1 << 18  # bytes of a text taken at once
SLICE = 1 << 10  # fingerprints with equal blocks that are compared at once
MAX_AGREE = 5

_GAP = re.compile(rb"[\x20\x09-\x0D]")


def shingle_hashes(text: bytes, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of a text, repeats included, in arrays of bounded length.

    ASCII letters count as lower case, words are what white space separates. A text of fewer words than a
    shingle has its whole word sequence as the only one; a text without words has none.
    """
    digest, carried, full, at = xxhash.xxh64_intdigest, [], False, 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE)
        stop = gap.start() if gap else len(text)
        words = carried + text[at:stop].lower().split()
        at = stop
        n = len(words) - size + 1
        if n <= 0:
            carried = words
            continue
        joined = b" ".join(words)
        ends = list(accumulate(len(w) + 1 for w in words))
        spans = zip([0, *ends[:n - 1]], ends[size - 1:])
        yield np.fromiter((digest(joined[a:b - 1], SEED) for a, b in spans), np.uint64, n)
        carried, full = words[n:], True
    if carried and not full:
        yield np.array([digest(b" ".join(carried), SEED)], np.uint64)


def simhash(text: bytes, size: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text: a bit is 1 if it is set in over half of the shingles' hashes."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, size):
        n += len(hashes)
        for at in range(0, len(hashes), 1 << 14):
            part = hashes[at:at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little") if n else np.zeros(8, np.uint8)
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint`` (the 64 bits as a signed long) of every row; whole texts, null like empty."""
    ship(docs.sparkSession)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            prints = np.array([simhash(t.as_py() or b"", size) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fingerprint"]
            )

    rows = docs.select("doc_id", "text")
    schema = StructType([rows.schema["doc_id"], StructField("fingerprint", LongType(), False)])
    return rows.mapInArrow(mark, schema)


def block_masks(distance: int, agree: int) -> list[int]:
    """The bits of each choice of ``agree`` out of ``distance + agree`` blocks, as signed longs."""
    n = distance + agree
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [(m ^ (1 << 63)) - (1 << 63) for m in (sum(c) for c in combinations(blocks, agree))]


def agreeing(n: int, distance: int) -> int:
    """How many blocks must be equal so that few of ``n`` even fingerprints meet by chance."""
    for agree in range(1, MAX_AGREE):
        if n <= 1 << (64 // (distance + agree) * agree):
            return agree
    return MAX_AGREE


def spanning_links(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Positions of linked fingerprints: as few links as connect all that links connect.

    One row of distances after the other, until all is connected; a dense group is after a few rows.
    """
    label, links, parts = np.arange(len(prints)), [], len(prints)
    for i in range(len(prints)):
        near = np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= distance)
        own = label[i]
        for root, first in zip(*np.unique(label[near], return_index=True)):
            if root != own:
                links.append((i, int(near[first])))
                label[label == root] = own
                parts -= 1
        if parts == 1:
            break
    return links


def _connect(distance: int):
    """Links inside each run of rows with equal ``keys`` (all columns but the last, the fingerprint)."""

    def links_of(prints: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        size = ends - starts
        two = starts[size == 2]
        a, b = prints[two], prints[two + 1]
        near = np.bitwise_count(a ^ b) <= distance
        out = [np.stack([a[near], b[near]])]
        for s, e in zip(starts[size > 2], ends[size > 2]):
            if found := spanning_links(prints[s:e], distance):
                out.append(prints[s:e][np.array(found).T])
        return out

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in _with_end(batches):
            table = held
            if batch is not None:
                rows = pa.Table.from_batches([batch])
                table = rows if held is None else pa.concat_tables([held, rows])
            if table is None or not table.num_rows:
                continue
            keys = [table.column(i).to_numpy() for i in range(table.num_columns - 1)]
            prints = table.column(table.num_columns - 1).to_numpy().view(np.uint64)
            new = np.zeros(len(prints), bool)
            new[0] = True
            for key in keys:
                new[1:] |= key[1:] != key[:-1]
            edges = np.append(np.flatnonzero(new), len(prints))
            done = len(edges) - 1 if batch is None else len(edges) - 2  # the last run may go on
            found = np.concatenate(links_of(prints, edges[:done], edges[1:done + 1]), axis=1).view(np.int64)
            held = table.slice(int(edges[done]))
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])

    return connect


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def links(prints: DataFrame, distance: int = DISTANCE, slice_size: int = SLICE) -> DataFrame:
    """``a, b``: links of at most ``distance`` bits that connect all that such links connect.

    ``prints`` holds different values in ``fingerprint``. Fingerprints with equal blocks meet in one
    group. A group of more than ``slice_size`` is dealt into slices by hash, and every two slices meet in
    a group of their own: no group outgrows a task, no pair is left out, and of the pairs that
    meet only links that connect something leave the task.
    """
    ship(prints.sparkSession)
    masks = block_masks(distance, agreeing(prints.count(), distance))
    blocks = F.array(*(F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks))
    keyed = prints.select("fingerprint", F.posexplode(blocks).alias("choice", "block"))
    crowded = stored(
        keyed.groupBy("choice", "block").agg(F.count("*").alias("members"))
        .where(F.col("members") > slice_size), "crowded",
    )
    slices = F.coalesce(F.ceil(F.col("members") / slice_size), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("slices")).cast("int")
    dealt = (
        lookup(keyed, crowded, ["choice", "block"], ["members"], "left")
        .withColumn("slices", slices).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        # In a crowded group a slice meets itself in its meeting with any other.
        .where("slices = 1 OR own <> other")
        .select("choice", "block", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fingerprint")
    )
    meeting = ["choice", "block", "x", "y"]
    return (
        dealt.repartition(*meeting).sortWithinPartitions(*meeting, "fingerprint")
        .mapInArrow(_connect(distance), "a long, b long")
    )


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row; ``fingerprint`` is a signed long.

    ``component_id`` is the least doc_id that links of at most ``distance`` differing bits reach, its own
    included. Rows without words have fingerprint zero and link like any other. Rows with equal
    fingerprints are one node, however many. A row without doc_id links others but names no component; a
    component without any doc_id has none (null). An empty table gives no rows. Other columns are not read.
    """
    marked = stored(fingerprints(docs, size), "fingerprints")
    prints = stored(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(links(prints.select("fingerprint"), distance))
    rooted = stored(
        prints.join(roots, prints["fingerprint"] == roots["node"], "left")
        .select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")), "rooted",
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # Stored before it meets the rows: a fingerprint that a third of them have is split by the join then.
    classes = stored(rooted.join(named, "root").select("fingerprint", "component_id"), "classes")
    return marked.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hexadecimal(fingerprint: Column | str) -> Column:
    """16 lower-case hexadecimal digits of a signed long."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
