"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch is three tables of cells; each paragraph digest is added to one cell of each. Two sketches
of one size subtract cell by cell, which leaves the digests that differ, and peeling cells that hold a
single one gives them back. Where peeling gets stuck, both texts are sketched again with twice as many
cells. The smallest sketch, as text, is the fingerprint.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.llm.common import parts_for, ship, text_bytes, text_key

TABLE = 8  # cells of each of the three tables of a fingerprint
LONG_LINE = 120  # code points above which a line is cut at ends of sentences
BUCKET_BYTES = 16 << 20
_LIMIT = 1 << 24  # cells per table at which the digests themselves are compared

_MASK = (1 << 64) - 1
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def paragraphs(text: str) -> list[str]:
    """Lines without white space at their ends, no empty ones; long lines in groups of sentences.

    A group ends after a sentence whose hash says so, about every second, so that an edit moves only
    the borders next to it.
    """
    out = []
    for line in text.split("\n"):
        line = line.strip()
        if len(line) <= LONG_LINE:
            if line:
                out.append(line)
            continue
        group: list[str] = []
        for sentence in _SENTENCE.split(line):
            group.append(sentence)
            if xxhash.xxh3_64_intdigest(sentence) & 1 == 0:
                out.append(" ".join(group))
                group = []
        if group:
            out.append(" ".join(group))
    return out


def digests(text: str) -> list[int]:
    """One 64-bit digest per paragraph; the n-th copy of a paragraph has a digest of its own."""
    seen: Counter[str] = Counter()
    out = []
    for paragraph in paragraphs(text):
        out.append(xxhash.xxh3_64_intdigest(paragraph, seen[paragraph]))
        seen[paragraph] += 1
    return out


def _check(digest: int) -> int:
    return (digest * 0xC2B2AE3D27D4EB4F & _MASK) >> 32


def _cells(digest: int, table: int) -> tuple[int, int, int]:
    mixed = digest * (0x9E3779B97F4A7C15 + 2 * table) & _MASK
    mixed ^= mixed >> 29
    return mixed % table, table + (mixed >> 20) % table, 2 * table + (mixed >> 40) % table


@dataclass
class Sketch:
    """``size`` digests in 3 * ``table`` cells: how many, their sum and their checks' sum (both xor)."""

    table: int
    size: int
    counts: list[int]
    sums: list[int]
    checks: list[int]

    def __str__(self) -> str:
        n = 3 * self.table
        raw = struct.pack(
            f"<HI{n}H{n}Q{n}I", self.table, self.size, *[c & 0xFFFF for c in self.counts],
            *self.sums, *self.checks,
        )
        return base64.b64encode(raw).decode()


def parse(fingerprint: str) -> Sketch:
    raw = base64.b64decode(fingerprint)
    table, size = struct.unpack_from("<HI", raw)
    n = 3 * table
    values = struct.unpack_from(f"<{n}H{n}Q{n}I", raw, 6)
    return Sketch(table, size, list(values[:n]), list(values[n:2 * n]), list(values[2 * n:]))


def sketch(values: list[int], table: int = TABLE) -> Sketch:
    counts, sums, checks = [0] * (3 * table), [0] * (3 * table), [0] * (3 * table)
    for value in values:
        check = _check(value)
        for cell in _cells(value, table):
            counts[cell] += 1
            sums[cell] ^= value
            checks[cell] ^= check
    return Sketch(table, len(values), counts, sums, checks)


def peel(a: Sketch, b: Sketch) -> tuple[list[int], list[int]] | None:
    """The digests that only a and only b hold; None where the cells do not give them all."""
    table = a.table
    counts = [(x - y) & 0xFFFF for x, y in zip(a.counts, b.counts)]
    sums = [x ^ y for x, y in zip(a.sums, b.sums)]
    checks = [x ^ y for x, y in zip(a.checks, b.checks)]
    only: tuple[list[int], list[int]] = ([], [])
    pending = [i for i, c in enumerate(counts) if c in (1, 0xFFFF)]
    while pending:
        i = pending.pop()
        count = counts[i]
        if count not in (1, 0xFFFF) or checks[i] != _check(sums[i]):
            continue
        digest, check = sums[i], checks[i]
        if i not in _cells(digest, table):
            continue
        only[0 if count == 1 else 1].append(digest)
        for cell in _cells(digest, table):
            counts[cell] = (counts[cell] - count) & 0xFFFF
            sums[cell] ^= digest
            checks[cell] ^= check
            if counts[cell] in (1, 0xFFFF):
                pending.append(cell)
    if any(counts) or any(sums) or any(checks):
        return None
    return only


def difference(
    a: list[int], b: list[int], first: tuple[Sketch, Sketch] | None = None
) -> tuple[list[int], list[int]]:
    """The digests that only one of two versions holds, by sketches of growing size."""
    pair = first or (sketch(a), sketch(b))
    while True:
        found = peel(*pair)
        if found is not None:
            return found
        table = 2 * pair[0].table
        if table > max(64, 8 * (len(a) + len(b))) or table > _LIMIT:
            return sorted(set(a) - set(b)), sorted(set(b) - set(a))
        pair = (sketch(a, table), sketch(b, table))


def likeness(n_a: int, n_b: int, differing: int) -> float:
    """Share of the paragraphs of two versions that both hold; 1 if neither has any."""
    return (n_a + n_b - differing) / (n_a + n_b) if n_a + n_b else 1.0


def edited_text(text: str, following: str) -> str:
    """The text with its last third replaced by as many first code points of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, only_text array<long>, only_edited array<long>"
)
_NAMES = [
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    "only_text", "only_edited",
]
_TYPES = [
    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(),
    pa.list_(pa.int64()), pa.list_(pa.int64()),
]


def _signed(values: list[int]) -> list[int]:
    return [v - (1 << 64) if v >> 63 else v for v in sorted(values)]


def _route(firsts):
    """Each row to the range of the order it lies in; the first of a range also to the range before."""

    def route(batches):
        keys, rows = firsts.value  # ascending
        n = len(keys)
        for batch in batches:
            key = batch.column("_key").to_numpy(zero_copy_only=False)
            row = batch.column("_row").to_numpy(zero_copy_only=False)
            # Firsts that come before this row in ascending order, then those with its key.
            at = np.searchsorted(keys, key, side="left")
            upto = np.searchsorted(keys, key, side="right")
            for i in np.flatnonzero(upto - at):
                at[i] += np.searchsorted(rows[at[i]:upto[i]], row[i], side="left")
            at = np.minimum(at, n - 1)
            is_first = (keys[at] == key) & (rows[at] == row)
            columns = dict(zip(batch.schema.names, batch.columns))
            yield pa.RecordBatch.from_pydict(columns | {
                "_part": pa.array(at.astype(np.int64)), "_halo": pa.array(np.zeros(len(at), np.int32)),
            })
            if is_first.any():
                copies = pa.array(np.flatnonzero(is_first))
                # In the order of the walk, from large to small, the range before is the next greater.
                before = (at[is_first] + 1) % n
                yield pa.RecordBatch.from_pydict({k: v.take(copies) for k, v in columns.items()} | {
                    "_part": pa.array(before.astype(np.int64)),
                    "_halo": pa.array(np.ones(len(before), np.int32)),
                })

    return route


def _compare(batches: Iterator[pa.RecordBatch]):
    """Rows in order; the row after each is its next document, or the halo row of its range."""
    rows: list[tuple] = []
    held = None  # part, doc_id, text, digests, sketch

    def finish(this, following):
        _, doc_id, text, own, print_ = this
        edited = edited_text(text, following[2])
        edited_own = digests(edited)
        edited_print = sketch(edited_own)
        gone, new = difference(own, edited_own, (print_, edited_print))
        other, back = difference(own, following[3], (print_, following[4]))
        rows.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), str(print_), str(edited_print),
            likeness(len(own), len(edited_own), len(gone) + len(new)),
            likeness(len(own), len(following[3]), len(other) + len(back)),
            _signed(gone), _signed(new),
        ))

    for batch in batches:
        parts, halos = batch.column("_part").to_pylist(), batch.column("_halo").to_pylist()
        for part, halo, doc_id, text in zip(
            parts, halos, batch.column("doc_id").to_pylist(), batch.column("text")
        ):
            if halo and (held is None or held[0] != part):
                continue  # another halo row of a range that is finished
            value = text.as_py()
            own = digests(value)
            this = (part, doc_id, value, own, sketch(own))
            if held is not None and held[0] == part:
                finish(held, this)
            held = None if halo else this
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES
                )
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES
        )


def fingerprints_of_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of an edited version of it, and how like they are.

    The next document is that with the next smaller doc_id, after the last the first; rows with
    equal doc_id follow one another by a hash of their text, rows without doc_id come last. The edited text
    is ``edited_text`` of a document and its next. A null text is empty. ``near_edited`` and ``near_next``
    are the shares of paragraphs in common with the edited and the next text; ``only_text`` and
    ``only_edited`` the digests that peeling gave back. One row per input row; other columns are not
    read.
    """
    spark = docs.sparkSession
    ship(spark)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        key.alias("_key"), text_key("text").alias("_row"),
    )
    parts = parts_for(docs, text_bytes(docs, "text"), BUCKET_BYTES)
    # The first row, from the top, of each range of the order: a few bytes per 16 MB of text.
    firsts = (
        base.select("_key", "_row").repartitionByRange(parts, F.col("_key"), F.col("_row"))
        .groupBy(F.spark_partition_id()).agg(F.max(F.struct("_key", "_row")).alias("first"))
        .select("first.*").collect()
    )
    firsts = sorted(map(tuple, firsts)) or [(0, 0)]
    bounds = spark.sparkContext.broadcast((
        np.array([f[0] for f in firsts], dtype=np.int64), np.array([f[1] for f in firsts], dtype=np.int64),
    ))
    routed = "doc_id long, text string, _key long, _row long, _part long, _halo int"
    return (
        base.mapInArrow(_route(bounds), routed)
        .repartition(parts, "_part")
        .sortWithinPartitions("_part", "_halo", F.desc("_key"), F.desc("_row"))
        .mapInArrow(_compare, _DDL)
    )
