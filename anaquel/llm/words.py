"""Words and their hashes over Arrow batches, computed on the UTF-8 bytes with numpy.

A word is a run of bytes other than space and 0x09-0x0D; UTF-8 never uses these bytes inside
another character, so this equals the pattern ``[^\\x20\\x09-\\x0D]+`` on code points. All work is
done in pieces of bounded size, so a batch or a single very long text does not multiply in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18  # bytes hashed at once; the power tables of this size stay in cache
BLOCK_BYTES = 1 << 20  # texts are taken together up to this size

_BASE = 0x9E3779B97F4A7C15
_BASE2 = 0xD6E8FEB86659FD93
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if base not in _tables:
        pair = []
        for x in (base, pow(base, -1, 1 << 64)):
            column = np.full(PIECE + 1, x, dtype=np.uint64)
            column[0] = 1
            pair.append(np.multiply.accumulate(column))
        _tables[base] = (pair[0], pair[1])
    return _tables[base]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each value starts and ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1 + column.offset)
    at = at[column.offset:]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    starts, ends = at[:-1], at[1:]
    if column.null_count:
        ends = np.where(column.is_null().to_numpy(zero_copy_only=False), starts, ends)
    return raw, starts, ends


def blocks(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together have about ``BLOCK_BYTES``, one row at least."""
    total = np.cumsum(ends - starts)
    row, n = 0, len(starts)
    while row < n:
        before = total[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(total, before + BLOCK_BYTES, side="right")))
        yield row, stop
        row = stop


def word_spans(
    raw: np.ndarray, start: int, end: int, inner: np.ndarray, outside: np.ndarray = _IS_SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last byte of each word in raw[start:end]; no word crosses ``inner``.

    ``inner`` are the positions, sorted, where one text ends and the next begins; ``outside`` says for
    each byte value whether it separates words.
    """
    if end <= start:
        empty = np.zeros(0, np.int64)
        return empty, empty
    solid = ~outside[raw[start:end]]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    cut = inner[(inner > start) & (inner < end)] - start
    opens[cut] = solid[cut]
    closes[cut - 1] = solid[cut - 1]
    return np.flatnonzero(opens) + start, np.flatnonzero(closes) + (start + 1)


def span_hashes(raw: np.ndarray, first: np.ndarray, last: np.ndarray, base: int = _BASE) -> np.ndarray:
    """64-bit hashes of raw[first:last] for sorted, non-overlapping spans."""
    power, inverse = _powers(base)
    out = np.empty(len(first), dtype=np.uint64)
    done, n = 0, len(first)
    while done < n:
        at = int(first[done])
        stop = int(np.searchsorted(last, at + PIECE, side="right"))
        if stop <= done:  # one span longer than a piece
            h, size = 0, int(last[done]) - at
            for k in range(0, size, PIECE):
                part = raw[at + k:min(at + k + PIECE, at + size)].astype(np.uint64) + np.uint64(1)
                value = int(np.sum(part * power[:len(part)], dtype=np.uint64))
                h = (h + value * pow(base, k, 1 << 64)) % (1 << 64)
            out[done] = h
            done += 1
            continue
        part = raw[at:int(last[stop - 1])].astype(np.uint64)
        part += np.uint64(1)
        part *= power[:len(part)]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part, out=sums[1:])
        s = first[done:stop] - at
        e = last[done:stop] - at
        out[done:stop] = (sums[e] - sums[s]) * inverse[s]
        done = stop
    return mix(out)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n consecutive words from each position (n - 1 fewer than words)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:size].copy()
    for k in range(1, n):
        out *= np.uint64(_BASE2)
        out += words[k:k + size]
    return mix(out)


def block_words(
    raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: int, stop: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of rows row..stop: spans, and the index of each row's first word (one more at the end).

    Rows of one column lie one after the other; a gap left by a null value holds no words.
    """
    first, last = word_spans(raw, int(starts[row]), int(ends[stop - 1]), starts[row:stop])
    edges = np.searchsorted(first, np.append(starts[row:stop], ends[stop - 1]))
    return first, last, edges


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest value of each run of ``width`` (``pick``: np.minimum or np.maximum)."""
    size = len(values) - width + 1
    if size <= 0:
        return values[:0]
    out, reach = values, 1
    while reach * 2 <= width:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return pick(out[:size], out[rest:rest + size]) if rest else out[:size]
