"""WARC archives compressed record by record with Zstandard and a shared dictionary.

An archive is a skippable frame that holds the dictionary, then one Zstandard frame per record.
Tasks write archives of bounded size under names made of the partition, a running number and the
content's digest, first to a temporary name, so a task that runs twice leaves the same files and equal
archives stay apart. The reader gets an archive as
bytes, loads the dictionary from its leading frame, decodes one record at a time, and validates
headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.llm.common import ship, stored
from anaquel.session import scratch_path

MIN_DUPLICATE_BYTES = 0
ARCHIVE_BYTES = 16 << 20  # payload of an archive; a larger single record makes a larger one
DICTIONARY_BYTES = 16 << 10
SAMPLE_BYTES = 1 << 20  # leading payload of an archive that its dictionary is trained on
LEVEL = 3
READ_BYTES = 1 << 14  # compressed bytes fed to a frame at once; what is behind its end is read again

# Fixed values of the formats.
_DICTIONARY_FRAME = 0x184D2A5D
_FRAME = 0xFD2FB528
_CRLF = b"\r\n"
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive or a record that is not as the format wants it."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def write_record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None) -> bytes:
    """A response or, with ``refers_to``, a revisit record, which leaves the payload out."""
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", _DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "text/html; charset=utf-8"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    body = payload
    if refers_to is not None:
        head += [
            ("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(refers_to)),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
        body = b""
    head.append(("Content-Length", str(len(body))))
    lines = [_VERSION, *(f"{name}: {value}".encode() for name, value in head)]
    return _CRLF.join(lines) + _CRLF * 2 + body + _CRLF * 2


def read_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; raises where version, headers, lengths or digest are wrong."""
    head, mark, rest = data.partition(_CRLF * 2)
    lines = head.split(_CRLF)
    if not mark or lines[0] != _VERSION:
        raise WarcError("no WARC/1.1 record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip() or name.decode("latin-1").lower() in headers:
            raise WarcError(f"bad header line {line[:80]!r}")
        headers[name.decode("latin-1").lower()] = value.decode("utf-8").strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"no {name}")
    length = headers["content-length"]
    if not length.isascii() or not length.isdigit() or len(rest) != int(length) + 4:
        raise WarcError(f"block of {len(rest) - 4} bytes, Content-Length {length}")
    if rest[int(length):] != _CRLF * 2:
        raise WarcError("no end of record")
    block = rest[: int(length)]
    if headers["warc-type"] == "response":
        if headers.get("warc-payload-digest") != f"sha1:{payload_digest(block)}":
            raise WarcError("payload does not match its digest")
    elif "warc-refers-to" not in headers:
        raise WarcError("revisit without WARC-Refers-To")
    return headers, block


def train(samples: list[bytes]) -> bytes:
    """A dictionary of the samples; where there are too few to train on, their raw text."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def write_archive(records: list[bytes]) -> bytes:
    taken, size = [], 0
    for record in records:
        taken.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    dictionary = train(taken)
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
    out = [struct.pack("<II", _DICTIONARY_FRAME, len(packed)), packed]
    compressor = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True
    )
    out += [compressor.compress(record) for record in records]
    return b"".join(out)


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, decoded one frame at a time."""
    view = memoryview(data)
    at, dictionary = 0, None
    if len(view) >= 8:
        magic, size = struct.unpack_from("<II", view)
        if magic == _DICTIONARY_FRAME:
            if len(view) < 8 + size:
                raise WarcError("cut off in the dictionary")
            raw = bytes(view[8:8 + size])
            if len(raw) >= 4 and struct.unpack_from("<I", raw)[0] == _FRAME:
                raw = zstandard.ZstdDecompressor().decompress(raw)
            dictionary, at = zstandard.ZstdCompressionDict(raw), 8 + size
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(view):
        frame, parts, begin = decompressor.decompressobj(), [], at
        try:
            while not frame.eof and at < len(view):
                parts.append(frame.decompress(view[at:at + READ_BYTES]))
                at += READ_BYTES
        except zstandard.ZstdError as error:
            raise WarcError(f"frame at byte {begin}: {error}") from error
        if not frame.eof:
            raise WarcError(f"cut off in the frame at byte {begin}")
        at = min(at, len(view)) - len(frame.unused_data)
        yield read_record(b"".join(parts))


def _writer(folder: str):
    def put(name: str, data: bytes) -> None:
        system, path = pafs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        hidden = f"{path}/_{uuid.uuid4().hex}"
        with system.open_output_stream(hidden) as stream:
            stream.write(data)
        system.move(hidden, f"{path}/{name}")

    def archive(records: list[bytes], part: int, number: int) -> pa.RecordBatch:
        data = write_archive(records)
        name = f"{part:05d}-{number:05d}-{hashlib.sha256(data).hexdigest()}.warc.zst"
        put(name, data)
        return pa.RecordBatch.from_pydict(
            {"name": [name], "bytes": [len(data)], "records": [len(records)]}
        )

    def write(batches):
        context = TaskContext.get()
        part, number = context.partitionId() if context else 0, 0
        records, size = [], 0
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*[batch.column(i) for i in range(5)]):
                payload = html.as_buffer().to_pybytes()
                base32 = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                records.append(write_record(
                    page_id.as_py(), url.as_py(), payload, base32, refers_to.as_py()
                ))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield archive(records, part, number)
                    records, size, number = [], 0, number + 1
        if records:
            yield archive(records, part, number)

    return write


def _reader(with_payload: bool):
    def read(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, held = [], 0
                for headers, block in read_archive(content.as_buffer()):
                    revisit = headers["warc-type"] == "revisit"
                    full = headers.get("x-payload-length")
                    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
                    rows.append((
                        name, headers["warc-type"], headers.get("x-page-id") or None,
                        headers.get("warc-target-uri"), int(full) if revisit and full else len(block),
                        digest if revisit else payload_digest(block),
                        headers.get("x-refers-to-page-id"), headers, block if with_payload else None,
                    ))
                    held += len(block) if with_payload else 0
                    if len(rows) >= 1000 or held >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES
                        )
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES
                    )

    return read


_NAMES = [
    "archive", "record_type", "page_id", "url", "payload_bytes", "payload_digest", "refers_to",
    "headers", "payload",
]
_TYPES = [
    pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(),
    pa.map_(pa.string(), pa.string()), pa.binary(),
]
_READ_DDL = (
    "archive string, record_type string, page_id string, url string, payload_bytes long, "
    "payload_digest string, refers_to string, headers map<string,string>, payload binary"
)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_DUPLICATE_BYTES) -> DataFrame:
    """Write a record per page to archives in ``folder``; returns ``name, bytes, records`` per archive.

    The payload is the html in UTF-8, a null html is empty. Of the pages whose payloads are equal and
    have at least ``min_bytes`` bytes the one with the least page_id is a response, the others revisit
    it; all other pages are responses. Pages without page_id are responses that nothing refers to.
    A null url leaves the target out. Rows that repeat a page are written again.
    """
    ship(pages.sparkSession)
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        html.alias("payload"),
    ).withColumn("hex", F.sha1("payload"))
    seen = rows.where("page_id IS NOT NULL").select(
        "page_id", "hex", F.octet_length("payload").alias("size")
    ).where(F.col("size") >= min_bytes)
    seen = stored(seen, "payloads")
    first = seen.groupBy("hex").agg(F.min("page_id").alias("refers_to"))
    revisits = stored(
        seen.select("page_id", "hex").distinct().join(first, "hex")
        .where("page_id <> refers_to").select("page_id", "hex", "refers_to"),
        "revisits",
    )
    records = (
        rows.join(revisits, ["page_id", "hex"], "left")
        .select("page_id", "url", "payload", F.col("hex").alias("digest"), "refers_to")
        .sortWithinPartitions("page_id", "digest", "url")  # a task that runs again writes the same bytes
    )
    manifest = records.mapInArrow(_writer(folder), "name string, bytes long, records long")
    return stored(manifest, "manifest")


def read_archives(spark, folder: str, with_payload: bool = True) -> DataFrame:
    """A row per record of the archives in a folder, read by Spark's own file source.

    Lengths and digests are those of the whole payload, also for revisits. Any record that fails
    validation raises ``WarcError`` and with it the query.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("path", "content").mapInArrow(_reader(with_payload), _READ_DDL)


def round_trip(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    manifest = write_archives(pages, folder)
    if not manifest.head(1):  # no pages, so no archive and no folder
        return spark.createDataFrame([], _READ_DDL)
    return read_archives(spark, folder, with_payload)
