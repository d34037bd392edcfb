"""A replayable log of messages in shared files, and a streaming source that reads it by offsets.

A log is a folder. ``append`` writes a batch of messages as segments, files of one log partition each, and makes
them visible with one commit that names every segment's first and last offset. The source plans a
micro-batch from the commits alone: a task per segment that overlaps the offsets asked for. Offsets are kept in the query's checkpoint, so a
restart goes on where the last batch ended, and a new checkpoint reads the log again from any offsets.
It gives the columns of Spark's Kafka source that the ingest uses (value, partition, offset, timestamp).
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from anaquel.sources import snapshots

FORMATO = "registro"
SCHEMA = "value binary, partition int, offset bigint, timestamp timestamp"
SEGMENT_ROWS = 1_000_000
#: Rows of a batch and bytes of a column that a task reading a segment holds.
READ_ROWS, READ_BYTES = 10_000, 1 << 20


def append(messages: DataFrame, path: str, segment_rows: int = SEGMENT_ROWS) -> int:
    """Add messages (value, partition, offset, timestamp) behind the log's end; the commit's number.

    Rows without partition or offset have no place and are an error, as are offsets up to the log's end. Rows of one
    batch that share a place are both messages. An empty batch commits nothing (-1). A range shuffle by place spreads a
    partition that holds most messages over many segments.
    """
    spark, root = messages.sparkSession, path.rstrip("/")
    folder = f"segmentos/{uuid.uuid4().hex}"
    rows = messages.select(
        F.col("value").cast("binary").alias("value"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    )
    (
        rows.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset")
        .write.partitionBy("partition").option("maxRecordsPerFile", segment_rows)
        .parquet(f"{root}/{folder}")
    )
    written = spark.read.schema("value binary, offset bigint, timestamp timestamp, partition int").parquet(
        f"{root}/{folder}"
    )
    found = (
        written.groupBy("partition", F.input_file_name().alias("file"))
        .agg(
            F.min("offset").alias("first"), F.max("offset").alias("last"),
            F.count("*").alias("rows"), F.count("offset").alias("placed"),
        )
        .orderBy("partition", "first")
        .collect()  # a row per file, which the commit lists
    )
    if not found:
        return -1
    known = snapshots.versions(spark, root)
    ends = read_commit_ends(spark, root, known)
    segments, after = [], dict(ends)
    for row in found:
        if row.partition is None or row.placed < row.rows:
            raise ValueError("a message without partition or offset has no place in a log")
        if row.first < ends.get(str(row.partition), 0):
            raise ValueError(f"partition {row.partition} already reaches offset {ends[str(row.partition)]}")
        after[str(row.partition)] = max(after.get(str(row.partition), 0), row.last + 1)
        name = "/".join(row.file.rsplit("/", 2)[-2:])
        segments.append([row.partition, row.first, row.last, f"{folder}/{name}"])
    number = known[-1] + 1 if known else 0
    body = json.dumps({"segments": segments, "ends": after})
    snapshots.publish(spark, f"{root}/_commits", f"{number:012d}.json", body)
    return number


def read_commit_ends(spark: SparkSession, root: str, known: list[int]) -> dict[str, int]:
    """Next offset of each partition, as the last commit has it."""
    if not known:
        return {}
    name = f"{root}/_commits/{known[-1]:012d}.json"
    return json.loads(spark.read.text(name, wholetext=True).first()[0])["ends"]


def messages(spark: SparkSession, path: str, starting: str | dict[int, int] = "earliest") -> DataFrame:
    """The log as a stream, from its beginning, its end (``latest``) or given offsets by partition.

    Partitions that ``starting`` does not name are read from their beginning.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package
    spark.dataSource.register(LogSource)
    start = starting if isinstance(starting, str) else json.dumps(starting)
    return spark.readStream.format(FORMATO).option("path", path).option("startingOffsets", start).load()


@dataclass
class Segment(InputPartition):
    """The messages from ``start`` up to but not including ``end`` in one file."""

    file: str
    partition: int
    start: int
    end: int


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMATO

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options["path"], self.options.get("startingOffsets", "earliest"))


class LogReader(DataSourceStreamReader):
    """Offsets are ``{partition: next offset}``; a partition that is not named starts at its first message."""

    def __init__(self, path: str, starting: str) -> None:
        self.path, self.starting = path.rstrip("/"), starting
        self.commits: dict[str, dict] = {}

    def _refresh(self) -> None:
        files, root = _files(self.path)
        found = files.get_file_info(fs.FileSelector(f"{root}/_commits", allow_not_found=True))
        for info in sorted(found, key=lambda f: f.base_name):
            name = info.base_name
            if name.endswith(".json") and not name.startswith(".") and name not in self.commits:
                with files.open_input_stream(info.path) as stream:
                    self.commits[name] = json.loads(stream.read())

    def initialOffset(self) -> dict:
        if self.starting == "earliest":
            return {}
        if self.starting == "latest":
            return self.latestOffset()
        return json.loads(self.starting)

    def latestOffset(self) -> dict:
        self._refresh()
        return self.commits[max(self.commits)]["ends"] if self.commits else {}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        self._refresh()
        out = []
        for name in sorted(self.commits):
            for partition, first, last, file in self.commits[name]["segments"]:
                low = max(first, start.get(str(partition), 0))
                high = min(last + 1, end.get(str(partition), 0))
                if low < high:
                    out.append(Segment(f"{self.path}/{file}", partition, low, high))
        return out

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        """Rows are decoded as they are read, a page at a time: a task holds a batch, however large the segment."""
        files, path = _files(partition.file)
        with files.open_input_file(path) as source:
            segment = pq.ParquetFile(
                source, pre_buffer=False, buffer_size=READ_BYTES, coerce_int96_timestamp_unit="us"
            )
            # The writer's row groups hold consecutive offsets: those without a wanted one are not read.
            groups = [n for n in range(segment.num_row_groups) if _may_hold(segment.metadata.row_group(n), partition)]
            columns = ["value", "offset", "timestamp"]
            for batch in segment.iter_batches(READ_ROWS, groups, columns, use_threads=False):
                offset = batch.column("offset")
                within = pc.and_(pc.greater_equal(offset, partition.start), pc.less(offset, partition.end))
                batch = batch.filter(within)
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("value"),
                            pa.array([partition.partition] * batch.num_rows, pa.int32()),
                            batch.column("offset"),
                            batch.column("timestamp").cast(pa.timestamp("us", "UTC")),
                        ],
                        names=["value", "partition", "offset", "timestamp"],
                    )


def _may_hold(group: pq.RowGroupMetaData, segment: Segment) -> bool:
    """Whether a row group can hold offsets of a segment, by its statistics."""
    for n in range(group.num_columns):
        column = group.column(n)
        if column.path_in_schema == "offset" and column.statistics is not None and column.statistics.has_min_max:
            return column.statistics.max >= segment.start and column.statistics.min < segment.end
    return True


def _files(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (file:/x as Hadoop writes it, too) or of a plain path."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
