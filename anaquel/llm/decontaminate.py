"""Benchmark decontamination by the q-gram lemma, in overlapping diagonal bands, and banded alignment.

Every place of a benchmark item begins a window. A window of m characters that occurs in a text with at
most k edits shares at least m - q + 1 - k q of its q-grams with it, on diagonals (text position minus
item position) that span at most k. So the shared q-grams of the whole item are brought together in bands
of 2 k diagonals that overlap by k; windows that hold fewer of a band than the bound are out, those that
hold all their q-grams on one diagonal are found, the others are verified by a banded alignment.
Short items are searched for whole and exactly, by hashes of their lengths.

The benchmark is the query set. It is broadcast in blocks of a fixed size, one pass over the
texts for each, so its own size has no limit either.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.llm import words as W
from anaquel.llm.common import ship, text_key

Q = 10
WINDOW = 96  # characters; shorter items are one window
EDITS = 0.06  # edits per character of a window
DIFFERENT = 10  # different q-grams that every match of a window must keep
PERIOD = 4  # repetitions at up to this distance do not count as different
MIN_CHARS = 30  # an item of fewer characters is searched for without edits, as words of their own
ALIGNED = 1 << 14  # windows aligned at once
BLOCK_CHARS = 2 << 20  # benchmark text broadcast at once
CHUNK = 1 << 20  # characters of text searched at once
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22

_LOWER = np.array(
    [ord(low) if len(low := chr(c).lower()) == 1 else c for c in range(1 << 16)], dtype=np.uint32
)
_LOWER[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0x20


def characters(text: bytes) -> np.ndarray:
    """Code points in lower case, white space as spaces, one for one."""
    points = np.frombuffer(text.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    plain = points < len(_LOWER)
    return np.where(plain, _LOWER[np.where(plain, points, 0)], points)


def q_grams(points: np.ndarray) -> np.ndarray:
    """Hashes of the Q characters from each position, by doubling: 2, 4, 8 and 2 more."""
    if len(points) < Q:
        return np.zeros(0, dtype=np.uint64)
    one = points.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        b2, b4 = _BASE * _BASE, _BASE * _BASE * _BASE * _BASE
        two = one[:-1] * _BASE + one[1:]
        four = two[:-2] * b2 + two[2:]
        eight = four[:-4] * b4 + four[4:]
        return W.mix(eight[:-2] * b2 + two[8:])


def budget(size: int) -> int:
    """Edits allowed in a window: the share ``EDITS``, but so few that the lemma's bound is positive."""
    return max(0, min(int(EDITS * size), (size - Q) // Q))


@dataclass
class Index:
    """q-grams of a benchmark block. A window lies at ``begin:begin + size`` of ``points``; the windows of an
    item begin at each of its places, one after another."""

    item: list
    points: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    edits: np.ndarray  # the budget of its size
    allowed: np.ndarray  # the edits it may have, less where q-grams repeat; -1 if it is not searched for
    owner: np.ndarray  # index into ``item``
    first: np.ndarray  # first window of each item that has windows
    count: np.ndarray  # and their number
    grams: np.ndarray  # sorted hashes, one per q-gram and item
    source: np.ndarray  # their items, as indices into ``first``
    place: np.ndarray  # and their positions in them
    filter: np.ndarray
    short: dict  # by length: sorted hashes of short items, and their indices into ``item``


def different(grams: np.ndarray, width: int) -> np.ndarray:
    """Number of different values in each run of ``width``."""
    n = len(grams)
    order = np.argsort(grams, kind="stable")
    before = np.full(n, -1, dtype=np.int64)
    same = grams[order[1:]] == grams[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    # A value counts in the runs that begin after its last occurrence and reach it.
    here = np.arange(n)
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, np.maximum(before, here - width) + 1, 1)
    np.add.at(change, here + 1, -1)
    return np.cumsum(change[:-1])[:n - width + 1]


def index(items: list[tuple[object, str]]) -> Index:
    points, begin, size, owner, at = [], [], [], [], 0
    variety = []
    first, count, grams, source, place = [], [], [], [], []
    short: dict[int, list[tuple[np.uint64, int]]] = {}
    windows = 0
    for n, (_, text) in enumerate(items):
        own = characters(text.encode())
        if len(own) < MIN_CHARS:
            if len(own):
                *_, (_, whole) = runs(own, len(own))
                short.setdefault(len(own), []).append((whole[0], n))
            continue
        m = min(WINDOW, len(own))
        found = q_grams(own)
        grams.append(found)
        variety.append(different(found, m - Q + 1))
        source.append(np.full(len(found), len(first), dtype=np.int32))
        place.append(np.arange(len(found), dtype=np.int32))
        first.append(windows)
        count.append(len(own) - m + 1)
        begin.append(at + np.arange(count[-1]))
        size.append(np.full(count[-1], m, dtype=np.int32))
        owner.append(np.full(count[-1], n, dtype=np.int32))
        points.append(own)
        windows += count[-1]
        at += len(own)

    def joined(parts, kind):
        return np.concatenate(parts).astype(kind, copy=False) if parts else np.zeros(0, kind)

    all_grams, sizes = joined(grams, np.uint64), joined(size, np.int32)
    order = np.argsort(all_grams, kind="stable")
    seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
    seen[(all_grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    budgets = np.array([budget(m) for m in range(WINDOW + 1)], dtype=np.int32)[sizes]
    spare = np.floor_divide(joined(variety, np.int64) - DIFFERENT, Q)
    by_length = {}
    for length, pairs in short.items():
        hashes = np.array([h for h, _ in pairs], dtype=np.uint64)
        sort = np.argsort(hashes, kind="stable")
        by_length[length] = hashes[sort], np.array([n for _, n in pairs], dtype=np.int64)[sort]
    return Index(
        [i for i, _ in items], joined(points, np.uint32), joined(begin, np.int64), sizes, budgets,
        np.maximum(np.minimum(budgets, spare), -1), joined(owner, np.int32), np.array(first, dtype=np.int64), np.array(count, dtype=np.int64),
        all_grams[order], joined(source, np.int32)[order], joined(place, np.int32)[order], seen, by_length,
    )


def runs(points: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each length up to ``longest``: hashes of the characters from each position."""
    one = points.astype(np.uint64) + np.uint64(1)
    found = np.zeros(len(one) + 1, dtype=np.uint64)
    for length in range(1, min(longest, len(one)) + 1):
        with np.errstate(over="ignore"):
            found = found[:-1] * _BASE + one[length - 1:]
        yield length, W.mix(found)


def _wordlike(points: np.ndarray) -> np.ndarray:
    """ASCII letters, in lower case, and digits."""
    return (points >= 0x61) & (points <= 0x7A) | (points >= 0x30) & (points <= 0x39)


def whole(
    points: np.ndarray, text: np.ndarray, known: Index, edges: tuple[bool, bool] = (False, False)
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Short items in ``points``: item, start and end. ``text``: the text each position belongs to.

    A hit does not begin or end inside a run of letters and digits; ``edges`` says whether such a run goes on
    before the first and after the last position.
    """
    none = np.zeros(0, np.int64)
    found = [(none, none, none)]
    letter = _wordlike(points)
    glued = np.concatenate([[edges[0]], letter[1:] & letter[:-1] & (text[1:] == text[:-1]), [edges[1]]])
    for length, hashes in runs(points, max(known.short, default=0)):
        if length not in known.short:
            continue
        keys, items = known.short[length]
        low = np.searchsorted(keys, hashes, side="left")
        at = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == hashes)
        at = at[(text[at] == text[at + length - 1]) & ~glued[at] & ~glued[at + length]]
        entry, source = _ranges(low[at], np.searchsorted(keys, hashes[at], side="right"))
        found.append((items[entry], at[source], at[source] + length))
    return tuple(map(np.concatenate, zip(*found)))


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges low:high, and the range each comes from."""
    count = high - low
    source = np.repeat(np.arange(len(low)), count)
    start = np.repeat(np.cumsum(count) - count, count)
    return np.arange(count.sum()) - start + low[source], source


def shared(points: np.ndarray, owner_end: np.ndarray, known: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """q-grams that texts and items share, where they are dense enough: item, place in it, diagonal.

    ``owner_end``: for each position the end of its text; q-grams across texts do not count.
    """
    none = (np.zeros(0, np.int64),) * 3
    grams = q_grams(points)
    if not len(grams) or not len(known.grams):
        return none
    hit = known.filter[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
    hit &= np.arange(len(grams)) + Q <= owner_end[: len(grams)]
    size, edits = known.size[known.first], known.edits[known.first]
    # A region with fewer hits than the least bound cannot hold any window: no pairs are made there. Nor are they in
    # one that holds too few different hits, such as a rule or an indentation, however often it repeats them: of a
    # region's different hits at most ``PERIOD`` are not new when they come up.
    reach = int((size + edits).max()) - Q + 1
    new = hit.copy()
    for back in range(1, PERIOD + 1):
        new[back:] &= grams[back:] != grams[:-back]
    here = np.arange(len(grams))
    end = np.minimum(here + reach, len(grams))

    def ahead(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[end] - total[here]

    dense = np.zeros(len(grams) + 1, dtype=np.int64)
    starts = np.flatnonzero(
        (ahead(hit) >= (size - Q + 1 - edits * Q).min()) & (ahead(new) >= DIFFERENT - PERIOD)
    )
    if not len(starts):
        return none
    np.add.at(dense, starts, 1)
    np.add.at(dense, np.minimum(starts + reach, len(grams)), -1)
    at = np.flatnonzero(hit & (np.cumsum(dense[:-1]) > 0))
    low = np.searchsorted(known.grams, grams[at], side="left")
    high = np.searchsorted(known.grams, grams[at], side="right")
    entry, source = _ranges(low, high)
    place = known.place[entry].astype(np.int64)
    return known.source[entry].astype(np.int64), place, at[source] - place


def _full(item, group, place, bound, known: Index) -> tuple[np.ndarray, np.ndarray]:
    """Windows, with their group, that hold ``bound`` of a group's places. A group is of one item; rows are
    in order of item, group and place, without twins."""
    none = np.zeros(0, np.int64)
    last = np.arange(len(item)) + bound - 1
    row = np.flatnonzero(last < len(item))
    last = last[row]
    reach = known.size[known.first[item]].astype(np.int64) - Q
    row_ok = (item[row] == item[last]) & (group[row] == group[last]) & (place[last] - place[row] <= reach[row])
    row, last = row[row_ok], last[row_ok]
    if not len(row):
        return none, none
    # Offsets that reach from the last place back to the first; rows of a group only add later ones.
    low = np.maximum(place[last] - reach[row], 0)
    high = np.minimum(place[row], known.count[item[row]] - 1) + 1
    again = (item[row[1:]] == item[row[:-1]]) & (group[row[1:]] == group[row[:-1]])
    low[1:] = np.where(again, np.maximum(low[1:], high[:-1]), low[1:])
    offset, source = _ranges(low, np.maximum(high, low))
    return known.first[item[row[source]]] + offset, group[row[source]]


def exact(item, place, diagonal, known: Index) -> tuple[np.ndarray, np.ndarray]:
    """Windows that a text holds without an edit: all their q-grams on one diagonal. Window and its start."""
    if not len(item):
        return item, diagonal
    order = np.lexsort((place, diagonal, item))
    item, place, diagonal = item[order], place[order], diagonal[order]
    window, diagonal = _full(item, diagonal, place, known.size[known.first[item]].astype(np.int64) - Q + 1, known)
    window, diagonal = _searched(window, diagonal, known)
    return window, diagonal + offset_of(known, window)


def _searched(window: np.ndarray, group: np.ndarray, known: Index) -> tuple[np.ndarray, np.ndarray]:
    """Without the windows that are not searched for."""
    keep = known.allowed[window] >= 0
    return window[keep], group[keep]


def bands(item, place, diagonal, known: Index) -> tuple[np.ndarray, np.ndarray]:
    """Window and band start (a diagonal of the window) of the bands that meet the bound."""
    if not len(item):
        return item, diagonal
    step = step_of(known, known.first[item])
    band = np.floor_divide(diagonal, step)
    # Band b holds the diagonals of steps b and b + 1.
    item = np.concatenate([item, item])
    band = np.concatenate([band, band - 1])
    place = np.concatenate([place, place])
    # A q-gram of the item counts once per band.
    order = np.lexsort((place, band, item))
    item, band, place = item[order], band[order], place[order]
    once = np.append(True, (item[1:] != item[:-1]) | (band[1:] != band[:-1]) | (place[1:] != place[:-1]))
    item, band, place = item[once], band[once], place[once]
    window = known.first[item]
    bound = known.size[window].astype(np.int64) - Q + 1 - known.edits[window] * Q
    window, band = _searched(*_full(item, band, place, bound, known), known)
    return window, band * step_of(known, window) + offset_of(known, window)


def candidates(points: np.ndarray, owner_end: np.ndarray, known: Index) -> tuple[np.ndarray, np.ndarray]:
    """Window and band start (a diagonal) of the bands that meet the bound, those of exact windows too."""
    return bands(*shared(points, owner_end, known), known)


def offset_of(known: Index, window: np.ndarray) -> np.ndarray:
    """Where in its item a window begins."""
    if not len(window):
        return np.zeros(0, np.int64)
    return window - known.first[np.searchsorted(known.first, window, side="right") - 1]


def step_of(known: Index, window: np.ndarray) -> np.ndarray:
    return np.maximum(known.edits[window], 1).astype(np.int64)


def align(points: np.ndarray, known: Index, window: np.ndarray, diagonal: np.ndarray, text_start, text_end):
    """Least edits of each window within its band, and where in ``points`` the best match ends.

    Rows of the dynamic programme are the window's characters, columns the band's diagonals, for all
    candidates at once. The match may start and end anywhere in the band, within its text.
    """
    n = len(window)
    size, step = known.size[window], step_of(known, window)
    width = int(2 * step.max() + 2 * known.edits.max() + 1) if n else 1
    first = diagonal - known.edits[window]  # diagonal of column 0
    column = np.arange(width)
    far = np.int32(1 << 20)

    def inside(row):  # positions the text has been read up to, after ``row`` characters of the window
        position = first[:, None] + column + row
        return (position >= text_start[:, None]) & (position <= text_end[:, None]), position

    ok, _ = inside(0)
    best = np.where(ok, 0, far).astype(np.int32)
    cost = np.full(n, far, dtype=np.int32)
    end = np.zeros(n, dtype=np.int64)
    for row in range(int(size.max()) + 1 if n else 0):
        if row:
            ok, position = inside(row)
            letter = known.points[np.minimum(known.begin[window] + row - 1, len(known.points) - 1)]
            read = points[np.clip(position - 1, 0, len(points) - 1)]
            take = best + ((read != letter[:, None]) | (position <= text_start[:, None])) * np.int32(1)
            take = np.where(position > text_start[:, None], take, far)
            drop = np.full_like(best, far)
            drop[:, :-1] = best[:, 1:] + 1  # the window's character is missing in the text
            best = np.where(ok, np.minimum(take, drop), far)
            # A character of the text that the window lacks: along the row.
            best = np.minimum.accumulate(best - column, axis=1) + column
            best = np.where(ok, best, far).astype(np.int32)
        done = size == row
        if done.any():
            cost[done] = best[done].min(axis=1)
            end[done] = first[done] + best[done].argmin(axis=1) + row
    return cost, end


_DDL = "doc_id long, _row long, item long, edits int, windows long, start long, stop long"


def _search(known):
    def search(batches: Iterator[pa.RecordBatch]):
        table = known.value
        overlap = max(MIN_CHARS, int((table.size + table.edits).max()) if len(table.size) else 0)
        for batch in batches:
            raw, starts, ends = W.utf8(batch.column("text"))
            ids, rows = batch.column("doc_id"), batch.column("_row")
            for row, stop in W.blocks(starts, ends):
                hits = list(_search_block(raw, starts, ends, row, stop, table, overlap))
                if hits:
                    doc, item, edits, windows, begin, end = _by_item(*map(np.concatenate, zip(*hits)))
                    at = pa.array(doc)
                    yield pa.RecordBatch.from_arrays([
                        ids.take(at), rows.take(at), pa.array(item), pa.array(edits.astype(np.int32)),
                        pa.array(windows), pa.array(begin), pa.array(end),
                    ], names=["doc_id", "_row", "item", "edits", "windows", "start", "stop"])

    return search


def _by_item(doc, item, edits, start, stop):
    """Per document and item: the least edits, the number of starts, the first start and the last stop."""
    order = np.lexsort((start, item, doc))
    doc, item, edits, start, stop = (v[order] for v in (doc, item, edits, start, stop))
    new = np.append(True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]))
    at = np.flatnonzero(new)
    once = new | np.append(True, start[1:] != start[:-1])
    return (
        doc[at], item[at].astype(np.int64), np.minimum.reduceat(edits, at),
        np.add.reduceat(once.astype(np.int64), at), start[at], np.maximum.reduceat(stop, at),
    )


def _search_block(raw, starts, ends, row, stop, table: Index, overlap: int):
    """Verified windows: row, item, edits, start and end in the text, for the rows of a block."""
    a = int(starts[row])
    joined = raw[a:int(ends[stop - 1])]
    points = characters(joined.tobytes())
    # Code points before each byte, at the texts' starts and ends.
    lead = np.zeros(len(joined) + 1, dtype=np.int64 if len(joined) >> 31 else np.int32)
    np.cumsum((joined & 0xC0) != 0x80, out=lead[1:])
    first, last = lead[starts[row:stop] - a].astype(np.int64), lead[ends[row:stop] - a].astype(np.int64)
    for low in range(0, max(1, len(points)), CHUNK):  # a very long text is searched in pieces
        part = points[low:low + CHUNK + overlap]
        text = np.minimum(np.searchsorted(last, np.arange(low, low + len(part)), side="right"), len(last) - 1)
        if table.short:
            item, begin, end = whole(part, text, table, (_glued(points, last, low), _glued(points, last, low + len(part))))
            if len(item):
                doc = text[begin]
                yield doc + row, item, np.zeros(len(item), np.int64), begin + low - first[doc], end + low - first[doc]
        grams = shared(part, last[text] - low, table)
        window, lies = exact(*grams, table)
        if len(window):
            doc = text[lies]
            begin = lies + low - first[doc]
            yield doc + row, table.owner[window], np.zeros(len(window), np.int64), begin, begin + table.size[window]
        # A window that lies there without an edit needs no alignment.
        window, diagonal = _rest(*bands(*grams, table), window, lies, table)
        for a in range(0, len(window), ALIGNED):
            yield from _verify(part, low, row, first, last, window[a:a + ALIGNED], diagonal[a:a + ALIGNED], table)


def _glued(points: np.ndarray, last: np.ndarray, at: int) -> bool:
    """Whether a run of letters and digits of one text goes over the border before ``at``."""
    return 0 < at < len(points) and bool(_wordlike(points[at - 1:at + 1]).all()) and at not in last


def _rest(window, diagonal, found, start, known: Index):
    """The bands that no exact place of their window lies in."""
    step = step_of(known, found)
    offset = offset_of(known, found)
    band = np.floor_divide(start - offset, step)
    key = lambda w, b: w * np.int64(1 << 32) + b
    mine = np.floor_divide(diagonal - offset_of(known, window), step_of(known, window))
    left = ~np.isin(key(window, mine), np.concatenate([key(found, band), key(found, band - 1)]))
    return window[left], diagonal[left]


def _verify(part, low, row, first, last, window, diagonal, table: Index):
    """The hits of a batch of candidate windows."""
    # A band may touch two texts, those at its two ends: both are tried, each cut off at its edges.
    middle = diagonal + step_of(table, window) + low
    tries = []
    for probe in (middle, middle + table.size[window] - 1):
        tries.append(np.clip(np.searchsorted(last, np.clip(probe, 0, None), side="right"), 0, len(last) - 1))
    again = tries[1] != tries[0]
    doc = np.concatenate([tries[0], tries[1][again]])
    window = np.concatenate([window, window[again]])
    diagonal = np.concatenate([diagonal, diagonal[again]])
    edits, end = align(
        part, table, window, diagonal,
        np.maximum(first[doc] - low, 0), np.minimum(last[doc] - low, len(part)),
    )
    good = edits <= table.allowed[window]
    if good.any():
        doc, window, end = doc[good], window[good], end[good] + low - first[doc[good]]
        yield doc + row, table.owner[window], edits[good].astype(np.int64), np.maximum(end - table.size[window], 0), end


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    rows = benchmark.select("item_id", "text").where("text <> ''").orderBy("item_id", "text")
    block, held = [], 0
    for item_id, text in rows.toLocalIterator():
        block.append((item_id, text))
        held += len(text)
        if held >= BLOCK_CHARS:
            yield block
            block, held = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, edits, windows, start, stop, _row`` per document and benchmark item found in it.

    A window of an item (``WINDOW`` characters from any place, or the whole of a shorter item) is found if
    it aligns with a part of the text with at most ``EDITS`` edits per character; the case of letters and
    the kind of white space do not count. A window in which q-grams repeat may have fewer edits, so that a match keeps
    ``DIFFERENT`` of them; one with fewer than that (a rule, an indentation) says nothing and is not searched for. An item shorter than ``MIN_CHARS`` is found without edits, and not
    inside a longer run of ASCII letters and digits. ``edits`` is the least of the windows found,
    ``windows`` the number of places where they begin, ``start`` and ``stop`` the code points from the first
    to the last. Null or empty texts hold nothing; null or empty items are not searched for; equal items
    are each found. Rows that repeat a doc_id and its text count once. ``doc_id`` may be null. No other
    columns are read. An empty benchmark or corpus gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key("text").alias("_row"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    kind = benchmark.schema["item_id"].dataType
    found = None
    for block in _blocks(benchmark):
        known = spark.sparkContext.broadcast(index(block))
        names = spark.createDataFrame(
            [(n, item_id) for n, (item_id, _) in enumerate(block)],
            f"item long, item_id {kind.simpleString()}",
        )
        hits = texts.mapInArrow(_search(known), _DDL).groupBy("doc_id", "_row", "item").agg(
            F.min("edits").alias("edits"), F.max("windows").alias("windows"),
            F.min("start").alias("start"), F.max("stop").alias("stop"),
        )
        # As many names as the block has items: bounded by the block's size.
        part = hits.join(F.broadcast(names), "item").drop("item")
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame(
            [], f"doc_id long, _row long, edits int, windows long, start long, stop long, item_id {kind.simpleString()}"
        )
    return found.select("doc_id", "item_id", "edits", "windows", "start", "stop", "_row")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns as they are."""
    leaks = find_leaks(docs, benchmark).select(
        F.col("doc_id").alias("_d"), F.col("_row").alias("_t")
    ).distinct()
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("_doc"), text_key("text").alias("_text")
    )
    same = F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t"))
    return rows.join(leaks, same, "left_anti").select("row.*")
