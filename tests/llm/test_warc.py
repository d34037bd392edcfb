"""WARC archives: exact round trip, duplicates, validation of broken archives, corner cases."""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
import pytest
import zstandard

from anaquel.llm import warc
from tests.llm.conftest import prose

PAGES = "page_id long, url string, html string"


def rows_of(pages, **options):
    return warc.round_trip(pages, with_payload=True, **options).collect()


def test_round_trip(spark):
    pages = [(i, f"http://h/{i}", f"<p>{prose(i % 30, 40)}é</p>\r\n\r\nWARC/1.1") for i in range(90)]
    got = {int(r.page_id): r for r in rows_of(spark.createDataFrame(pages, PAGES).repartition(5))}
    assert len(got) == 90
    for i, url, html in pages:
        body, r = html.encode(), got[i]
        assert r.url == url and r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert r.record_type == ("response" if i < 30 else "revisit")
        assert r.refers_to == (None if i < 30 else str(i % 30))
        assert r.payload == (body if i < 30 else b"")


def test_odd_rows(spark, with_clashes):
    long = prose(1, 400_000)
    pages = [
        (5, None, None), (3, "a\r\nb", ""), (3, "a\r\nb", ""), (None, "n", "x"), (7, "x", "x"), (9, "é", long), (10, "y", long),
    ]
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes, str(r.url))
                 for r in rows_of(with_clashes(spark.createDataFrame(pages, PAGES))))
    assert got == sorted([
        ("5", "revisit", "3", 0, "None"), ("3", "response", "None", 0, "a%0D%0Ab"),
        ("3", "response", "None", 0, "a%0D%0Ab"), ("None", "response", "None", 1, "n"),
        ("7", "response", "None", 1, "x"), ("9", "response", "None", len(long), "é"),
        ("10", "revisit", "9", len(long), "y"),
    ])
    assert rows_of(spark.createDataFrame([], PAGES)) == []


def test_small_payloads_are_not_revisited(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long" * 9), (4, "d", "long" * 9)], PAGES)
    folder = f"file://{tmp_path}/w"
    warc.write_archives(pages, folder, min_bytes=10)
    got = {r.page_id: r.record_type for r in warc.read_archives(spark, folder).collect()}
    assert got == {"1": "response", "2": "response", "3": "response", "4": "revisit"}


def test_writing_again_leaves_the_same_files(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", prose(i, 50)) for i in range(40)], PAGES)
    folder = f"file://{tmp_path}/w"
    first = {tuple(r) for r in warc.write_archives(pages, folder).collect()}
    assert {tuple(r) for r in warc.write_archives(pages, folder).collect()} == first
    assert warc.read_archives(spark, folder).count() == 40


def test_equal_rows_in_two_partitions(spark):
    for page_id in (7, None):
        pages = spark.createDataFrame([(page_id, "u", "same")] * 8, PAGES).repartition(2)
        got = rows_of(pages)
        assert len(got) == 8 and len({r.archive for r in got}) == 2


def test_equal_archives_of_one_task(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1)
    batch = pa.RecordBatch.from_pylist(
        [{"page_id": None, "url": "u", "payload": b"same", "digest": hashlib.sha1(b"same").hexdigest(), "refers_to": None}] * 3,
        schema=pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
                          ("digest", pa.string()), ("refers_to", pa.int64())]),
    )
    folder = f"file://{tmp_path}/w"
    for _ in range(2):  # a task that runs again leaves the same files
        made = list(warc._writer(folder)([batch]))
        assert sum(m.column("records")[0].as_py() for m in made) == 3
        assert len(list((tmp_path / "w").iterdir())) == 3


@pytest.fixture
def archive():
    digest = warc.payload_digest(b"hello")
    return warc.write_archive([warc.write_record(i, "u", b"hello", digest) for i in range(20)])


def test_format(archive):
    magic, size = struct.unpack_from("<II", archive)
    assert magic == 0x184D2A5D
    dictionary = zstandard.ZstdDecompressor().decompress(archive[8:8 + size])
    assert dictionary
    assert len(list(warc.read_archive(archive))) == 20
    # Without a dictionary, and with one that is not compressed itself.
    record = warc.write_record(1, "u", b"x", warc.payload_digest(b"x"))
    assert len(list(warc.read_archive(zstandard.ZstdCompressor().compress(record) * 2))) == 2
    raw = b"WARC/1.1 WARC-Type: response" * 9
    frame = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw)).compress(record)
    plain = struct.pack("<II", 0x184D2A5D, len(raw)) + raw + frame
    assert len(list(warc.read_archive(plain))) == 1
    assert list(warc.read_archive(b"")) == []


@pytest.mark.parametrize("break_", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/9.9", 1),
    lambda r: r.replace(b"Content-Length: 5", b"Content-Length: 6"),
    lambda r: r.replace(b"Content-Length: 5", b"Content-Length: -5"),
    lambda r: r.replace(b"Content-Length: 5\r\n", b""),
    lambda r: r.replace(b"WARC-Type", b"WARC Type:x\r\nno colon", 1),
    lambda r: r.replace(b"hello", b"jello"),
    lambda r: r[:-1],
    lambda r: r + b"x",
    lambda r: r.replace(b"WARC-Date: ", b"X: "),
])
def test_broken_records_raise(break_):
    record = warc.write_record(1, "u", b"hello", warc.payload_digest(b"hello"))
    assert warc.read_record(record)[1] == b"hello"
    with pytest.raises(warc.WarcError):
        warc.read_record(break_(record))


def test_broken_archives_raise(archive):
    for broken in (archive[:-3], archive[:20], archive[:-40] + b"\x00" * 40):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(broken))
