"""Substring dedup over the de Bruijn graph of the corpus' words.

Every window of ``WINDOW`` words is an edge of the graph; a text is a path. An edge that occurs once
cannot matter and is kept out by an anchor: the least hash of the 10-word runs inside the window, which
is the same wherever the window occurs.

1. Anchors of all texts are brought together. What occurs once goes; only about a sixth of the
   positions are ever sent, and most end here.
2. A join brings the repeated anchors' places back to their texts. The edges there are dealt by their
   own hashes, and each occurrence is joined to the source of its edge: the first document and
   position, in order of doc_id.
3. Occurrences that follow one another in a text, and whose sources follow one another too, are a
   nonbranching path and compact to one span with one source. Spans meet their texts by a join.

An edge is known by 96 bits: its own hash and half of its anchor's. Copies inside one batch are settled
there, so an edge or an anchor that a third of all texts hold costs one row per batch, and edges are
dealt by their own hash, not by their anchor, so one phrase in many contexts is spread too.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.llm import words as W
from anaquel.llm.common import parts_for, ship, text_bytes, text_key

WINDOW = 20
ANCHOR = 10
RUN = WINDOW - ANCHOR + 1  # anchors that lie inside a window
BUCKET_BYTES = 16 << 20  # text behind one bucket, on average
FLUSH = 1 << 19  # occurrences gathered before they are sent

_NONE = np.zeros(0, dtype=np.uint64)


def anchored(raw, starts, ends, row: int, stop: int):
    """Words of a block: hashes, the rows' edges, 10-word runs, each window's anchor (0: no window)."""
    first, last, edges = W.block_words(raw, starts, ends, row, stop)
    hashes = W.span_hashes(raw, first, last)
    if len(hashes) < WINDOW:
        return hashes, edges, _NONE, _NONE
    owner = np.repeat(np.arange(stop - row), np.diff(edges))
    runs = W.grams(hashes, ANCHOR)
    least = W.sliding(runs, RUN, np.minimum).copy()
    least[owner[: len(least)] != owner[WINDOW - 1:]] = 0
    return hashes, edges, runs, least


def anchor_places(runs: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Positions of the runs that are the least of some window."""
    if not len(least):
        return np.zeros(0, np.int64)
    edge = np.zeros(RUN - 1, dtype=np.uint64)
    return np.flatnonzero(
        (W.sliding(np.concatenate([edge, least, edge]), RUN, np.maximum) == runs) & (runs != 0)
    )


def _deal(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[tuple[int, dict]]:
    """The rows of each bucket, in the order given."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    columns = {name: values[order] for name, values in columns.items()}
    for a, z in zip(cuts[:-1], cuts[1:]):
        if z > a:
            yield int(bucket[a]), {name: values[a:z] for name, values in columns.items()}


def _firsts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows in order: the index of the first row with the same keys, and which rows have a twin."""
    order = np.lexsort(keys[::-1])  # stable: rows of one key stay in order
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
    group = np.cumsum(new) - 1
    source = np.empty(len(order), dtype=np.int64)
    source[order] = order[np.flatnonzero(new)][group]
    twin = np.empty(len(order), dtype=bool)
    twin[order] = np.bincount(group)[group] > 1 if len(order) else False
    return source, twin


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _values(column: pa.ChunkedArray, kind) -> np.ndarray:
    parts = [np.frombuffer(v.as_buffer(), kind) for v in column if v.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


_ASKED = pa.schema([
    ("bucket", pa.int32()), ("anchors", pa.binary()), ("docs", pa.binary()), ("places", pa.binary()),
    ("sure_docs", pa.binary()), ("sure_places", pa.binary()),
])
_ASKED_DDL = (
    "bucket int, anchors binary, docs binary, places binary, sure_docs binary, sure_places binary"
)


def _send_anchors(buckets: int):
    """Anchors with their places, by bucket of the hash; places known to be repeated, by document."""

    def flush(found) -> pa.RecordBatch:
        anchor = np.concatenate([f[0] for f in found])
        doc = np.concatenate([f[1] for f in found])
        place = np.concatenate([f[2] for f in found])
        source, twin = _firsts(anchor)
        asked = source == np.arange(len(source))
        rows: dict[int, dict] = {}
        columns = {"anchors": anchor[asked], "docs": doc[asked], "places": place[asked]}
        for b, part in _deal((anchor[asked] % np.uint64(buckets)).astype(np.int64), columns):
            rows.setdefault(b, {"bucket": b}).update({n: v.tobytes() for n, v in part.items()})
        columns = {"sure_docs": doc[twin], "sure_places": place[twin]}
        for b, part in _deal(doc[twin] % buckets, columns):
            rows.setdefault(b, {"bucket": b}).update({n: v.tobytes() for n, v in part.items()})
        return _rows(list(rows.values()), _ASKED)

    def send(batches):
        found, held = [], 0
        for batch in batches:
            raw, starts, ends = W.utf8(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for row, stop in W.blocks(starts, ends):
                _, edges, runs, least = anchored(raw, starts, ends, row, stop)
                at = anchor_places(runs, least)
                owner = np.searchsorted(edges, at, side="right") - 1
                found.append((runs[at], ids[row + owner], (at - edges[owner]).astype(np.uint32)))
                held += len(at)
                if held > FLUSH:
                    yield flush(found)
                    found, held = [], 0
        if held:
            yield flush(found)

    return send


def _repeated(table: pa.Table) -> pa.Table:
    """Places whose anchor occurs again, from one bucket."""
    anchor = _values(table["anchors"], np.uint64)
    _, twin = _firsts(anchor)
    docs = np.append(_values(table["docs"], np.int64)[twin], _values(table["sure_docs"], np.int64))
    places = np.append(
        _values(table["places"], np.uint32)[twin], _values(table["sure_places"], np.uint32)
    )
    return pa.table({"doc_id": docs, "place": places.astype(np.int32)})


_EDGE_COLUMNS = (
    "keys", "checks", "docs", "rows", "places",
    "sure_docs", "sure_rows", "sure_places", "sure_source_docs", "sure_sources",
)
_EDGES = pa.schema([("bucket", pa.int32()), *[(name, pa.binary()) for name in _EDGE_COLUMNS]])
_EDGES_DDL = "bucket int, " + ", ".join(f"{name} binary" for name in _EDGE_COLUMNS)
_SOURCED_DDL = (
    "bucket int, docs binary, rows binary, places binary, source_docs binary, sources binary"
)
_REPEATS_DDL = "doc_id long, _row long, places binary, source_docs binary, sources binary"


def _sourced(key, check, doc, row, place):
    """Occurrences in order of document and place, each with the index of its edge's first one."""
    order = np.lexsort((place, row, doc))
    key, check, doc, row, place = (v[order] for v in (key, check, doc, row, place))
    source, _ = _firsts(key, check)
    return key, check, doc, row, place, source


def _send_edges(buckets: int):
    """Edges at repeated anchors. The first occurrence in a batch of texts goes to the bucket of its
    edge; later ones are settled and go by document."""

    def flush(found) -> pa.RecordBatch:
        columns = [np.concatenate([f[i] for f in found]) for i in range(5)]
        key, check, doc, row, place, source = _sourced(*columns)
        first = source == np.arange(len(source))
        rows: dict[int, dict] = {}
        open_ = {"keys": key, "checks": check, "docs": doc, "rows": row, "places": place}
        open_ = {name: values[first] for name, values in open_.items()}
        for b, part in _deal((open_["keys"] % np.uint64(buckets)).astype(np.int64), open_):
            rows.setdefault(b, {"bucket": b}).update({n: v.tobytes() for n, v in part.items()})
        # Rows that repeat a document with its text are that document, not copies of it.
        later = (doc != doc[source]) | (row != row[source]) | (place != place[source])
        sure = {
            "sure_docs": doc[later], "sure_rows": row[later], "sure_places": place[later],
            "sure_source_docs": doc[source[later]], "sure_sources": place[source[later]],
        }
        for b, part in _deal(doc[later] % buckets, sure):
            rows.setdefault(b, {"bucket": b}).update({n: v.tobytes() for n, v in part.items()})
        return _rows(list(rows.values()), _EDGES)

    def send(batches):
        found, held = [], 0
        for batch in batches:
            raw, starts, ends = W.utf8(batch.column("text"))
            ids = pc.fill_null(batch.column("doc_id"), 0).to_numpy(zero_copy_only=False)
            rows_of = batch.column("_row").to_numpy(zero_copy_only=False)
            asked = batch.column("places")
            for row, stop in W.blocks(starts, ends):
                hashes, edges, runs, least = anchored(raw, starts, ends, row, stop)
                if not len(least):
                    continue
                wanted = np.zeros(len(runs), dtype=bool)
                for i in range(stop - row):
                    if asked[row + i].is_valid:
                        at = edges[i] + np.asarray(asked[row + i].values.to_numpy(), np.int64)
                        wanted[at[at < min(edges[i + 1], len(runs))]] = True
                if not wanted.any():
                    continue
                # A window is wanted if the anchor it chose is: the least run at a wanted place.
                marked = np.where(wanted, runs, np.uint64(0xFFFFFFFFFFFFFFFF))
                near = W.sliding(marked, RUN, np.minimum)
                at = np.flatnonzero((near == least) & (least != 0))
                if not len(at):
                    continue
                owner = np.searchsorted(edges, at, side="right") - 1
                found.append((
                    W.grams(hashes, WINDOW)[at], least[at].astype(np.uint32),
                    ids[row + owner].astype(np.int64), rows_of[row + owner].astype(np.int64),
                    (at - edges[owner]).astype(np.uint32),
                ))
                held += len(at)
                if held > FLUSH:
                    yield flush(found)
                    found, held = [], 0
        if held:
            yield flush(found)

    return send


def _join_sources(buckets: int):
    """From one bucket of edges: every occurrence that has an earlier one, with its source, by bucket
    of its document."""

    def join(table: pa.Table) -> pa.Table:
        kinds = {"keys": np.uint64, "checks": np.uint32, "docs": np.int64, "rows": np.int64, "places": np.uint32}
        _, _, doc, row, place, source = _sourced(*[_values(table[n], k) for n, k in kinds.items()])
        # Rows that repeat a document with its text are that document, not copies of it.
        again = (doc != doc[source]) | (row != row[source]) | (place != place[source])
        columns = {
            "docs": np.append(doc[again], _values(table["sure_docs"], np.int64)),
            "rows": np.append(row[again], _values(table["sure_rows"], np.int64)),
            "places": np.append(place[again], _values(table["sure_places"], np.uint32)),
            "source_docs": np.append(doc[source][again], _values(table["sure_source_docs"], np.int64)),
            "sources": np.append(place[source][again], _values(table["sure_sources"], np.uint32)),
        }
        dealt = list(_deal(columns["docs"] % buckets, columns))
        return pa.table({
            "bucket": pa.array([b for b, _ in dealt], pa.int32()),
            **{n: pa.array([part[n].tobytes() for _, part in dealt], pa.binary()) for n in columns},
        })

    return join


def _by_document(table: pa.Table) -> pa.Table:
    """From one bucket of documents: a row per document with its repeated windows and their sources."""
    kinds = {
        "docs": np.int64, "rows": np.int64, "places": np.uint32, "source_docs": np.int64, "sources": np.uint32,
    }
    docs, rows, places, source_docs, sources = (_values(table[n], k) for n, k in kinds.items())
    order = np.lexsort((rows, docs))
    docs, rows, places, source_docs, sources = (v[order] for v in (docs, rows, places, source_docs, sources))
    new = np.append(True, (docs[1:] != docs[:-1]) | (rows[1:] != rows[:-1]))[: len(docs)]
    cuts = np.append(np.flatnonzero(new), len(docs))
    parts = list(zip(cuts[:-1], cuts[1:]))
    return pa.table({
        "doc_id": pa.array(docs[cuts[:-1]], pa.int64()), "_row": pa.array(rows[cuts[:-1]], pa.int64()),
        "places": pa.array([places[a:z].tobytes() for a, z in parts], pa.binary()),
        "source_docs": pa.array([source_docs[a:z].tobytes() for a, z in parts], pa.binary()),
        "sources": pa.array([sources[a:z].tobytes() for a, z in parts], pa.binary()),
    })


def compact(places: np.ndarray, source_docs: np.ndarray, sources: np.ndarray) -> np.ndarray:
    """Spans ``start, words, source_doc, source_start`` of a text from its repeated windows.

    Windows that follow one another and whose sources follow one another in one text are one span. Repeated
    rows name a window more than once: its first source counts.
    """
    order = np.lexsort((sources, source_docs, places))
    places, source_docs, sources = places[order].astype(np.int64), source_docs[order], sources[order].astype(np.int64)
    once = np.ones(len(places), dtype=bool)
    once[1:] = places[1:] != places[:-1]
    places, source_docs, sources = places[once], source_docs[once], sources[once]
    new = np.ones(len(places), dtype=bool)
    new[1:] = (
        (places[1:] != places[:-1] + 1) | (source_docs[1:] != source_docs[:-1])
        | (sources[1:] != sources[:-1] + 1)
    )
    at = np.flatnonzero(new)
    windows = np.diff(np.append(at, len(places)))
    return np.column_stack([places[at], windows + WINDOW - 1, source_docs[at], sources[at]])


_RESULT_DDL = (
    "doc_id long, n_words long, n_removed long, kept string, "
    "spans array<struct<start: int, words: int, source_doc: long, source_start: int>>"
)
_SPAN = pa.struct([
    ("start", pa.int32()), ("words", pa.int32()), ("source_doc", pa.int64()), ("source_start", pa.int32()),
])


def _cut(batches):
    for batch in batches:
        n_words, n_removed, kept, spans = [], [], [], []
        for text, key, repeats in zip(
            batch.column("text"), batch.column("_row").to_pylist(), batch.column("repeats")
        ):
            words = text.as_buffer().to_pybytes().split()
            removed = np.zeros(len(words) + 1, dtype=np.int64)
            found = np.zeros((0, 4), dtype=np.int64)
            mine = [r for r in repeats.values if r["_row"].as_py() == key] if repeats.is_valid else []
            if mine:
                found = compact(*[
                    np.concatenate([np.frombuffer(r[n].as_buffer(), kind) for r in mine])
                    for n, kind in (("places", np.uint32), ("source_docs", np.int64), ("sources", np.uint32))
                ])
                np.add.at(removed, found[:, 0], 1)
                np.add.at(removed, found[:, 0] + found[:, 1], -1)
            stays = np.cumsum(removed[:-1]) == 0
            n_words.append(len(words))
            n_removed.append(int(len(words) - stays.sum()))
            kept.append(b" ".join(compress(words, stays.tolist()) if len(found) else words))
            spans.append([dict(zip(("start", "words", "source_doc", "source_start"), map(int, f))) for f in found])
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, pa.list_(_SPAN)),
        ], names=["doc_id", "n_words", "n_removed", "kept", "spans"])


def drop_repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept, spans``.

    Words are runs of anything but space and 0x09-0x0D. Every word goes that lies in a window of
    ``WINDOW`` words whose word sequence starts earlier too: in a smaller doc_id, or before it in the
    same document. Windows are judged on the input. ``kept`` holds the other words, joined by one
    space; ``spans`` the repeated passages with a place where each is found earlier. A null text has
    no words. Rows that repeat a doc_id and its text are one document; rows that share a doc_id with
    other texts are ordered by a hash of the text. A row without doc_id neither loses words nor counts
    as a source. No other column is read.
    """
    ship(docs.sparkSession)
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key("text").alias("_row"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    buckets = parts_for(docs, text_bytes(docs, "text"), BUCKET_BYTES)
    places = (
        base.where("doc_id IS NOT NULL").select("doc_id", "text")
        .mapInArrow(_send_anchors(buckets), _ASKED_DDL)
        .groupBy("bucket").applyInArrow(_repeated, "doc_id long, place int")
        .groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    )
    repeats = (
        base.join(places, "doc_id", "left")
        .mapInArrow(_send_edges(buckets), _EDGES_DDL)
        .groupBy("bucket").applyInArrow(_join_sources(buckets), _SOURCED_DDL)
        .groupBy("bucket").applyInArrow(_by_document, _REPEATS_DDL)
        .groupBy("doc_id").agg(
            F.collect_list(F.struct("_row", "places", "source_docs", "sources")).alias("repeats")
        )
    )
    return base.join(repeats, "doc_id", "left").mapInArrow(_cut, _RESULT_DDL)
