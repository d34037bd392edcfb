"""Near-duplicates: consistent weighted sampling over TF-IDF shingles, banded, then verified.

1. One pass counts in how many documents each shingle occurs, in a counting sketch of fixed size.
2. A second pass gives every document its samples (improved consistent weighted sampling) and hashes
   them to band values.
3. Texts that are equal form one node. Nodes that share a band value are compared with the most central
   of them, that which shares most values with others; the verified links make components.
4. What this leaves open, members of one value in different components, is compared in blocks of
   bounded size inside the tasks; only links that join components leave a block, never pairs.

Every link is verified by the weighted Jaccard similarity of the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.llm import words as W
from anaquel.llm.common import lean, ship, stored

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 12
ROWS = 3  # samples per band: a pair at 0.8 shares no band with probability 0.488**12 < 0.0002
SKETCH_BITS = 22
CELLS = 1 << 12  # counters per row while the sketch is summed
RARE = 0.1  # share of all documents below which all shingles count as equally rare
SUB = 1 << 15  # shingles sampled at once
BLOCK = 512  # nodes on each side of a block of comparisons
SLAB = 4096  # shingles in a matrix of such a block

_U32 = np.uint32


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the word runs of a text; a text of fewer words is one run."""
    if 0 < len(hashes) < size:
        return W.grams(hashes, len(hashes))
    return W.grams(hashes, size)


def block_shingles(
    raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: int, stop: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row (sorted by row and hash), their counts, and the rows' edges."""
    first, last, edges = W.block_words(raw, starts, ends, row, stop)
    hashes = W.span_hashes(raw, first, last)
    count = np.diff(edges)
    if len(count) and count.min() >= SHINGLE:
        # All runs of the block at once, without those that reach into the next text.
        all_runs = W.grams(hashes, SHINGLE)
        owner = np.repeat(np.arange(len(count)), count)
        inside = owner[: len(all_runs)] == owner[SHINGLE - 1:]
        runs, owner = all_runs[inside], owner[: len(all_runs)][inside]
    else:
        parts = [shingles(hashes[a:b]) for a, b in zip(edges[:-1], edges[1:])]
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        runs = np.concatenate(parts) if parts else hashes[:0]
    # Sorted by text and hash, the number of the text in the upper bits.
    bits = max(1, int(len(count) - 1).bit_length())
    packed = (owner.astype(np.uint64) << np.uint64(64 - bits)) | (runs >> np.uint64(bits))
    packed.sort()
    if not len(packed):
        return packed, np.zeros(0, np.int64), np.zeros(len(count) + 1, np.int64)
    new = np.flatnonzero(np.append(True, packed[1:] != packed[:-1]))
    times = np.diff(np.append(new, len(packed)))
    distinct = packed[new]
    of = (distinct >> np.uint64(64 - bits)).astype(np.int64)
    # The block's size must not show in the hash, so only the bits that every block keeps are used.
    code = (distinct << np.uint64(bits)) >> np.uint64(20)
    return W.mix(code), times, np.searchsorted(of, np.arange(len(count) + 1))


def _cell(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _rows(batches: Iterator[pa.RecordBatch], text: str):
    """For each batch and block: the batch, the rows' range, and the block's shingles."""
    for batch in batches:
        raw, starts, ends = W.utf8(batch.column(text))
        for row, stop in W.blocks(starts, ends):
            yield batch, row, stop, block_shingles(raw, starts, ends, row, stop)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """The sketch of document counts by shingle cell, and the number of documents.

    The sketch has 2**22 counters whatever the corpus; a shingle shares its counter with others that
    occur in a share of about (shingles per text) / 2**22 of the documents, far below ``RARE``.
    """

    def count(batches):
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for _, _, _, (codes, _, _) in _rows(batches, "text"):
            np.add.at(sketch, _cell(codes), _U32(1))  # in place: no second array of counters
        for at in range(0, len(sketch), CELLS):
            part = sketch[at:at + CELLS]
            if part.any():
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([at // CELLS], pa.int32()), "counts": [part.tobytes()]}
                )

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(counts.as_buffer(), dtype=np.uint32)
                if part in totals:
                    totals[part] += values
                else:
                    totals[part] = values.astype(np.uint64)
        for part, values in totals.items():
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "counts": [values.tobytes()]}
            )

    schema = "part int, counts binary"
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = docs.select("text").mapInArrow(lean(count), schema).repartition(tasks, "part").mapInArrow(lean(add), schema)
    sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint64)
    for part, counts in sums.toLocalIterator():  # 32 MB in all, whatever the corpus
        values = np.frombuffer(bytes(counts), dtype=np.uint64)
        sketch[part * CELLS:part * CELLS + len(values)] = values
    return sketch, docs.count()


def idf(frequencies: np.ndarray, n_docs: int) -> np.ndarray:
    """log(1 + N / df) with df at least ``RARE`` of all documents and at least 2.

    So boilerplate counts less, but the shingles of a group of copies, however many of the corpus' texts
    below that share belong to it, do not count less than the edits that tell the copies apart.
    """
    least = max(2.0, RARE * n_docs)
    return np.log1p(max(n_docs, 1) / np.maximum(frequencies, least)).astype(np.float32)


_LOG = -np.log((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)


def _scramble(x: np.ndarray, times: int) -> np.ndarray:
    y = x * _U32(times)
    y ^= y >> _U32(16)
    y *= _U32(0x7FEB352D)
    y ^= y >> _U32(15)
    y *= _U32(0x846CA68B)
    y ^= y >> _U32(16)
    return y


def samples(codes: np.ndarray, log_weight: np.ndarray, edges: np.ndarray, k: int) -> np.ndarray:
    """Improved consistent weighted sampling, draw k: one 32-bit sample per text.

    For a shingle with weight w: r and c are Gamma(2, 1), b is uniform, all from its hash;
    t = floor(ln w / r + b), and the shingle with the least ln c - r (t - b + 1) is drawn with its t.
    Two texts agree in a draw with a probability of their weighted Jaccard similarity.
    """
    x = codes.astype(_U32) ^ (codes >> np.uint64(32)).astype(_U32)
    y = _scramble(x, 0x9E3779B1 + 2 * k * 0x10001)
    z = _scramble(y + x, 0x85EBCA77 + 2 * k)
    b = ((y ^ z) * _U32(0xC2B2AE3D) >> _U32(8)).astype(np.float32)
    b *= np.float32(2.0**-24)
    r = _LOG[y >> _U32(16)] + _LOG[y & _U32(0xFFFF)]
    c = _LOG[z >> _U32(16)] + _LOG[z & _U32(0xFFFF)]
    t = np.floor(log_weight / r + b)
    value = np.log(c) - r * (t - b + np.float32(1)) + np.float32(128)
    np.maximum(value, np.float32(0), out=value)
    drawn = x * _U32(0x2C1B3C6D) ^ t.astype(np.int32).view(_U32) * _U32(0x297A2D39)
    packed = (value.view(_U32).astype(np.uint64) << np.uint64(32)) | drawn
    return np.minimum.reduceat(packed, edges).astype(_U32)


def band_values(codes: np.ndarray, weights: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Band values (texts x bands) of texts that each have a shingle."""
    out = np.empty((len(edges) - 1, BANDS), dtype=np.uint64)
    log_weight = np.log(weights)
    row, n = 0, len(edges) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(edges, edges[row] + SUB, side="right")) - 1)
        a, z = edges[row], edges[stop]
        part, log_part, at = codes[a:z], log_weight[a:z], edges[row:stop] - a
        for band in range(BANDS):
            value = np.full(stop - row, band + 1, dtype=np.uint64)
            for k in range(band * ROWS, (band + 1) * ROWS):
                value = W.mix(value * np.uint64(0x9E3779B97F4A7C15) + samples(part, log_part, at, k))
            out[row:stop, band] = value
        row = stop
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts given as distinct codes and weights."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64)) - low
    return low / total if total else 1.0


def _signatures(base: DataFrame, weights) -> DataFrame:
    """Band values of every row that has a word; equal texts get equal values."""
    names = ["doc_id", "_h1", "_h2"]

    def sign(batches):
        table = weights.value
        for batch, row, stop, (codes, times, edges) in _rows(batches, "text"):
            full = np.flatnonzero(np.diff(edges))
            if not len(full):
                continue
            w = table[_cell(codes)] * times.astype(np.float32)
            values = band_values(codes, w, np.append(edges[full], edges[-1]))
            at = pa.array(full + row)
            yield pa.RecordBatch.from_pydict({
                **{name: batch.column(name).take(at) for name in names},
                "bands": pa.ListArray.from_arrays(
                    pa.array(np.arange(0, values.size + 1, BANDS, dtype=np.int32)),
                    pa.array(values.reshape(-1).view(np.int64)),
                ),
            })

    schema = "doc_id long, _h1 long, _h2 long, bands array<long>"
    return base.select(*names, "text").mapInArrow(lean(sign), schema)


def _verify(pairs: DataFrame, texts: DataFrame, weights) -> DataFrame:
    """``a, b, distance`` of node pairs: 1 - weighted Jaccard similarity of their whole texts."""

    def measure(batches):
        table = weights.value
        last: tuple[int, tuple] = (-1, ())

        def profile(raw, starts, ends, i):
            codes, times, _ = block_shingles(raw, starts, ends, i, i + 1)
            return codes, table[_cell(codes)] * times.astype(np.float32)

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b")
            left, right = W.utf8(batch.column("text_a")), W.utf8(batch.column("text_b"))
            distance = np.empty(len(a))
            for i, node in enumerate(a):
                if last[0] != node:
                    last = (node, profile(*left, i))
                distance[i] = 1.0 - similarity(last[1], profile(*right, i))
            yield pa.RecordBatch.from_pydict(
                {"a": batch.column("a"), "b": b, "distance": pa.array(distance)}
            )

    of_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    of_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    return (
        pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "text_a", "text_b")
        .mapInArrow(lean(measure), "a long, b long, distance double")
    )


def _profiles(texts: DataFrame) -> DataFrame:
    """``node, codes, times``: the distinct shingles of a text and how often each occurs, as bytes."""

    def describe(batches):
        for batch, row, stop, (codes, times, edges) in _rows(batches, "text"):
            at = list(zip(edges[:-1], edges[1:]))
            yield pa.RecordBatch.from_pydict({
                "node": batch.column("node").slice(row, stop - row),
                "codes": pa.array([codes[a:z].tobytes() for a, z in at], pa.binary()),
                "times": pa.array([times[a:z].astype(np.int32).tobytes() for a, z in at], pa.binary()),
            })

    return texts.select("node", "text").mapInArrow(lean(describe), "node long, codes binary, times binary")


def similarities(codes: list[np.ndarray], weights: list[np.ndarray], n_left: int) -> np.ndarray:
    """Weighted Jaccard similarities of the first ``n_left`` texts (rows) with the others (columns).

    A shingle that occurs t times is given as t codes of its own, so the least of two weights is the weight
    of the codes that both texts have, and the sums are a product of matrices.
    """
    owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    joined, weight = np.concatenate(codes), np.concatenate(weights).astype(np.float64)
    total = np.bincount(owner, weights=weight, minlength=len(codes))
    known, column, count = np.unique(joined, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    here = np.flatnonzero(shared[column])
    here = here[np.argsort(column[here], kind="stable")]
    row, at, value = owner[here], number[column[here]], weight[here]
    low = np.zeros((n_left, len(codes) - n_left))
    for first in range(0, int(shared.sum()), SLAB):  # so many shared shingles at once
        a, z = np.searchsorted(at, [first, first + SLAB])
        left = np.zeros((n_left, SLAB))
        right = np.zeros((len(codes) - n_left, SLAB))
        is_left = row[a:z] < n_left
        left[row[a:z][is_left], at[a:z][is_left] - first] = value[a:z][is_left]
        right[row[a:z][~is_left] - n_left, at[a:z][~is_left] - first] = 1.0
        low += left @ right.T
    high = total[:n_left, None] + total[None, n_left:] - low
    return np.divide(low, high, out=np.ones_like(low), where=high > 0)


def _compare_blocks(weights, threshold: float):
    def unary(codes: bytes, times: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code, n = np.frombuffer(codes, np.uint64), np.frombuffer(times, np.int32)
        copy = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out = np.repeat(code, n)
        return np.where(copy > 0, W.mix(out + copy.astype(np.uint64)), out), np.repeat(table[_cell(code)], n)

    def compare(block: pa.Table) -> pa.Table:
        table = weights.value
        block = block.sort_by("side")
        side, node, root = (block[c].to_numpy() for c in ("side", "node", "root"))
        n_left = int((side == 0).sum())
        links: list[tuple[int, int]] = []
        if 0 < n_left < len(side):
            parts = [
                unary(c.as_buffer(), t.as_buffer(), table) for c, t in zip(block["codes"], block["times"])
            ]
            like = similarities([p[0] for p in parts], [p[1] for p in parts], n_left)
            x, y = np.nonzero((like >= threshold - 1e-6) & (root[:n_left, None] != root[None, n_left:]))
            y += n_left
            # One link per pair of components is enough: which ones, is the same every time.
            _, first = np.unique(
                np.column_stack([np.minimum(root[x], root[y]), np.maximum(root[x], root[y])]), axis=0, return_index=True
            )
            links = list(zip(node[x[first]].tolist(), node[y[first]].tolist()))
        return pa.table({
            "a": pa.array([p[0] for p in links], pa.int64()), "b": pa.array([p[1] for p in links], pa.int64())
        })

    return compare


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the least node of each connected component of ``a, b`` links.

    Alternating star contraction: every node's neighbours are moved to its least neighbour until
    all components are stars. Only minima are aggregated, never lists of neighbours.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct(), "links",
    )
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        # Larger neighbours of u go to the least node around u.
        large = (
            both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        large = stored(large, "large")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u"), F.col("m").alias("v")),
            )).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        )
        small = stored(small, "small")
        # Stars: every end has one centre, and no node is both an end and a centre.
        roles = small.select("u", F.lit(1).alias("as_end")).union(small.select("v", F.lit(0))).groupBy("u").agg(
            F.sum("as_end").alias("centres"), F.min("as_end").alias("only_end")
        )
        unfinished = roles.where("centres > 1 OR (centres = 1 AND only_end = 0)")
        if not unfinished.count():
            return small.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = small


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``doc_id, class_id`` and its text's hashes; class_id is the least doc_id of the class.

    A class holds the documents that verified links connect: equal texts, and texts whose TF-IDF
    weighted Jaccard similarity over ``SHINGLE`` words is at least ``threshold`` (found with a
    probability of at least 0.9998 per pair). Null and empty texts are equal texts. Rows with the
    same doc_id are one document per text. A row without doc_id is in no class (null). No other
    column is read.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", text.alias("text")).withColumns(
        {"_h1": F.xxhash64("text"), "_h2": F.xxhash64(F.lit("second"), "text")}
    )
    frequencies, n_docs = document_frequencies(base)
    weights = spark.sparkContext.broadcast(idf(frequencies, n_docs))  # 16 MB

    identified = base.where("doc_id IS NOT NULL")
    keys = stored(identified.select("doc_id", "_h1", "_h2"), "keys")
    groups = keys.groupBy("_h1", "_h2").agg(F.min("doc_id").alias("least_id"))
    # A node is a text; doc_id names it, unless two texts share a doc_id: then all but one get a hash.
    twice = groups.groupBy("least_id").agg(F.min("_h1").alias("_first"))
    groups = stored(
        groups.join(twice, "least_id").select(
            "_h1", "_h2", "least_id",
            F.when(F.col("_h1") == F.col("_first"), F.col("least_id"))
            .otherwise(F.xxhash64("least_id", "_h1", "_h2")).alias("node"),
        ), "nodes",
    )
    named = groups.withColumnRenamed("least_id", "doc_id")
    row = ["doc_id", "_h1", "_h2"]
    signed = stored(
        _signatures(identified, weights).join(named, row)
        .dropDuplicates(["node"]).select("node", "bands"), "signatures",
    )

    values = signed.select("node", F.explode("bands").alias("value"))
    sizes = values.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(values.join(sizes, "value"), "shared")
    central = shared.groupBy("node").agg(F.sum("n").alias("centrality"))
    members = shared.join(central, "node")
    leaders = members.groupBy("value").agg(F.max("centrality").alias("centrality"))
    leaders = (
        members.join(leaders, ["value", "centrality"]).groupBy("value").agg(F.min("node").alias("leader"))
    )
    members = stored(shared.join(leaders, "value").select("value", "leader", "node"), "members")
    texts = stored(
        identified.join(named.join(members.select("node").distinct(), "node", "left_semi"), row)
        .dropDuplicates(["node"]).select("node", "text"), "compared",
    )
    star = members.where("leader <> node").select(
        F.col("leader").alias("a"), F.col("node").alias("b")
    ).distinct()
    links = stored(_verify(star, texts, weights), "distances").where(F.col("distance") <= 1.0 - threshold + 1e-6)
    roots = components(links)

    # A value is open if two of its members that are no leaders lie in different components.
    lead = roots.select(F.col("node").alias("leader"), F.col("root").alias("lead_root"))
    around = stored(
        members.where("leader <> node").join(roots, "node", "left").join(lead, "leader", "left").select(
            "value", "node", F.coalesce("root", "node").alias("root"),
            F.coalesce("lead_root", "leader").alias("lead_root"),
        ), "around",
    )
    outside = F.col("root") != F.col("lead_root")
    blocks_of = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    open_values = (
        around.groupBy("value").agg(
            F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("n"),
            F.count(F.when(outside, True)).alias("n_out"), F.bit_xor(F.xxhash64("node", "lead_root")).alias("set"),
        )
        .where("least <> most AND n_out > 0")
        # Values with the same members need one comparison.
        .groupBy("set", "n").agg(F.min("value").alias("value"), F.max("n_out").alias("n_out"))
        .select("value", blocks_of(F.col("n_out")).alias("k_out"), blocks_of(F.col("n")).alias("k"))
    )
    opened = around.join(open_values, "value")
    each = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    own = lambda k: F.pmod(F.xxhash64("node"), F.col(k)).cast("int")
    sides = (
        opened.where(outside).select("value", "node", "root", F.lit(0).alias("side"), own("k_out").alias("i"), each("k").alias("j"))
        .union(opened.select("value", "node", "root", F.lit(1).alias("side"), each("k_out").alias("i"), own("k").alias("j")))
    )
    profiles = _profiles(texts.join(opened.select("node").distinct(), "node", "left_semi"))
    more = stored(
        sides.join(profiles, "node").groupBy("value", "i", "j")
        .applyInArrow(_compare_blocks(weights, threshold), "a long, b long"), "more",
    )
    joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(joined.union(more))

    classed = groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = classed.groupBy("root").agg(F.min("least_id").alias("class_id"))
    of_text = classed.join(least, "root").select("_h1", "_h2", "class_id")
    return (
        base.select("doc_id", "_h1", "_h2").join(of_text, ["_h1", "_h2"], "left")
        .select(
            "doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"),
            F.col("_h1").alias("text_hash_1"), F.col("_h2").alias("text_hash_2"),
        )
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without all but one document of each class: that with the least doc_id.

    Of rows that repeat a doc_id and its text one stays; rows without doc_id all stay. Other columns
    pass, whatever their names.
    """
    classes = near_duplicates(docs, threshold)
    seen = stored(classes.where("doc_id IS NOT NULL").select(
        F.col("doc_id").alias("_d"), F.col("text_hash_1").alias("_t"), "class_id"
    ), "classes")
    gone = seen.where("_d <> class_id").select("_d", "_t").distinct()
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("_doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"),
    )
    rest = rows.join(gone, (F.col("_doc") == F.col("_d")) & (F.col("_text") == F.col("_t")), "left_anti")
    if seen.groupBy("_d", "_t").agg(F.count("*").alias("_n")).where("_n > 1").head(1):
        named = rest.where("_doc IS NOT NULL").groupBy("_doc", "_text").agg(F.any_value("row").alias("row"))
        rest = named.select("row").union(rest.where("_doc IS NULL").select("row"))
    return rest.select("row.*")
