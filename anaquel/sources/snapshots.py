"""Versions of a folder of tables: written aside, published by one commit, read as of a version.

A draft writes into a folder of its own, so no reader ever sees a table that is half written or changes
under it. ``commit`` adds one small file that names every table's folders; the highest number is the current version.
A writer that dies before that leaves the current version as it was. Tables may go on using folders
of earlier versions: whole tables, or periods of tables that are stored by period. ``expire`` removes the folders that
none of the versions kept names any more.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from py4j.protocol import Py4JJavaError

from anaquel.settings import SERIE, SERIE_DIA
from anaquel.sources import writers

PERIODO = "yyyy-MM"
#: More files a period than this, and smaller ones on average, are put together when the period is written again.
MAX_FILES, SMALL_FILE = 8, 16 * 1024 * 1024
_SLOT = "_periodo"


class Conflict(RuntimeError):
    """Another writer has published a version since the draft began."""


@dataclass(frozen=True)
class Entry:
    """Where a table of a version lies, relative to the root."""

    path: str = ""
    schema: str = ""
    buckets: int = 0
    #: Folder of each period, for tables stored by period.
    periods: dict[str, str] | None = None
    #: Further folders of a period, with rows that have come to it since its own was written.
    more: dict[str, list[str]] | None = None

    def folders(self, periods: Iterable[str] | None = None) -> list[str]:
        """All folders, or those of some periods."""
        if self.periods is None:
            return [self.path]
        wanted = self.periods.keys() if periods is None else self.periods.keys() & set(periods)
        return [f for p in sorted(wanted) for f in (self.periods[p], *(self.more or {}).get(p, ()))]


@dataclass(frozen=True)
class Version:
    number: int
    root: str
    entries: dict[str, Entry] = field(default_factory=dict)
    #: What the writer wants its successor to know, such as a high-water mark.
    notes: dict[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root}/{self.entries[name].path}"

    def periods(self, name: str) -> list[str]:
        return sorted(self.entries[name].periods or ())

    def table(self, spark: SparkSession, name: str, periods: list[str] | None = None) -> DataFrame:
        """A table as this version has it; of one stored by period only ``periods``, if given."""
        entry = self.entries[name]
        schema = StructType.fromJson(json.loads(entry.schema))
        if entry.periods is not None:
            paths = [f"{self.root}/{f}" for f in entry.folders(periods)]
            if not paths:
                return spark.createDataFrame([], schema)
            return spark.read.schema(schema).parquet(*paths)
        if entry.buckets:
            return _by_series(spark, self.path(name), schema, entry.buckets)
        return spark.read.schema(schema).parquet(self.path(name))

    def scattered(self, spark: SparkSession, name: str, periods: list[str]) -> bool:
        """Whether these periods of a table lie in many small files."""
        sizes: list[int] = []
        for stored in self.entries[name].folders(periods):
            files, folder = _files(spark, f"{self.root}/{stored}")
            sizes += [s.getLen() for s in files.listStatus(folder) if s.getPath().getName().endswith(".parquet")]
        return len(sizes) > MAX_FILES * len(periods) and sum(sizes) < SMALL_FILE * len(sizes)

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: self.table(spark, name) for name, entry in self.entries.items() if entry.schema}


class Draft:
    """A version being written."""

    def __init__(self, spark: SparkSession, root: str, base: Version | None) -> None:
        self.spark, self.root, self.base = spark, root.rstrip("/"), base
        self.folder = f"versiones/{uuid.uuid4().hex}"
        self.entries: dict[str, Entry] = {}
        self.notes: dict[str, str] = {}

    def path(self, name: str, layer: str = "oro") -> str:
        """A place of the version for what is no table: a model, an export."""
        self.entries[name] = Entry(f"{self.folder}/{layer}/{name}")
        return f"{self.root}/{self.entries[name].path}"

    def save(self, name: str, df: DataFrame, layer: str = "oro") -> DataFrame:
        out = writers.materialise(df, self.path(name, layer))
        self._typed(name, out)
        return out

    def save_by_series(self, name: str, df: DataFrame, buckets: int, layer: str = "oro") -> DataFrame:
        out = writers.materialise_by_series(df, self.path(name, layer), buckets)
        self._typed(name, out, buckets)
        return out

    def save_partitioned(self, name: str, df: DataFrame, column: str, layer: str = "oro") -> DataFrame:
        out = writers.save_partitioned(df, self.path(name, layer), column)
        self._typed(name, out)
        return out

    def save_periods(
        self, name: str, df: DataFrame, periods: list[str] | None = None, layer: str = "oro", unit: str = PERIODO,
        placed: DataFrame | None = None, extended: Iterable[str] = (),
    ) -> None:
        """Store rows by the period of their ``fecha``.

        With ``periods`` the frame replaces just these of the base version's: those it has no rows of are gone,
        all others stay where they are. ``placed`` are more rows of the table, read from where they are stored by period:
        they are written by the tasks that read them. Of the periods, those ``extended`` keep the rows they have: the
        frame's go beside them.
        """
        path = self.path(name, layer)
        folder = self.entries[name].path
        slot = F.coalesce(F.date_format("fecha", unit), F.lit("sin fecha"))
        # Rebalanced by period: small periods share a task, one that outgrows a task is split.
        rows = df.withColumn(_SLOT, slot).hint("rebalance", F.col(_SLOT))
        if placed is not None:
            rows = placed.withColumn(_SLOT, slot).union(rows)
        rows.write.mode("overwrite").partitionBy(_SLOT).parquet(path)
        kept: dict[str, str] = {}
        more: dict[str, list[str]] = {}
        if periods is not None and self.base is not None and name in self.base.entries:
            old, replaced = self.base.entries[name], set(periods) - set(extended)
            kept = {p: f for p, f in (old.periods or {}).items() if p not in replaced}
            more = {p: f for p, f in (old.more or {}).items() if p in kept}
        written = {c.split("=", 1)[1]: f"{folder}/{c}" for c in _children(self.spark, path) if "=" in c}
        beside = kept.keys() & written.keys()
        more |= {p: [*more.get(p, ()), written[p]] for p in beside}
        self.entries[name] = Entry(folder, json.dumps(df.schema.jsonValue()), 0, written | kept, more or None)

    def keep(self, name: str) -> None:
        """The table goes on as it is in the base version."""
        self.entries[name] = self.base.entries[name]

    def table(self, name: str, periods: list[str] | None = None) -> DataFrame:
        return Version(0, self.root, self.entries).table(self.spark, name, periods)

    def commit(self) -> Version:
        """Publish: from here on ``latest`` is this version. ``Conflict`` if another came first."""
        number = 1 if self.base is None else self.base.number + 1
        version = Version(number, self.root, self.entries, self.notes)
        body = json.dumps({"entries": {n: asdict(e) for n, e in self.entries.items()}, "notes": self.notes})
        publish(self.spark, f"{self.root}/_commits", f"{number:012d}.json", body)
        return version

    def _typed(self, name: str, df: DataFrame, buckets: int = 0) -> None:
        self.entries[name] = Entry(self.entries[name].path, json.dumps(df.schema.jsonValue()), buckets)


def begin(spark: SparkSession, root: str) -> Draft:
    """A draft on top of the current version."""
    return Draft(spark, root, latest(spark, root))


def versions(spark: SparkSession, root: str) -> list[int]:
    names = _children(spark, f"{root.rstrip('/')}/_commits")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def latest(spark: SparkSession, root: str) -> Version | None:
    known = versions(spark, root)
    return at(spark, root, known[-1]) if known else None


def at(spark: SparkSession, root: str, number: int) -> Version:
    root = root.rstrip("/")
    files, path = _files(spark, f"{root}/_commits/{number:012d}.json")
    stream = files.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    body = json.loads(text)
    return Version(number, root, {n: Entry(**e) for n, e in body["entries"].items()}, body["notes"])


def expire(spark: SparkSession, root: str, keep: int = 2, abandoned_hours: float = 24.0) -> list[int]:
    """Remove all but the last ``keep`` versions, with the folders that only they name; their numbers.

    Folders that no commit names belong to drafts; those older than ``abandoned_hours`` go as well.
    """
    root = root.rstrip("/")
    known = versions(spark, root)
    old, kept = known[:-keep], known[-keep:]
    needed = {f for n in kept for e in at(spark, root, n).entries.values() for f in e.folders()}
    drafts = {f.split("/")[1] for n in known for e in at(spark, root, n).entries.values() for f in e.folders()}
    gone = {f for n in old for e in at(spark, root, n).entries.values() for f in e.folders()} - needed
    for number in old:  # first the commits: what they name must not be found when it goes
        writers.remove(spark, f"{root}/_commits/{number:012d}.json")
    for folder in gone:
        if not any(n.startswith(f"{folder}/") for n in needed):
            writers.remove(spark, f"{root}/{folder}")
    before = (time.time() - abandoned_hours * 3600) * 1000
    files, path = _files(spark, f"{root}/versiones")
    for status in files.listStatus(path) if files.exists(path) else ():
        if status.getPath().getName() not in drafts and status.getModificationTime() < before:
            files.delete(status.getPath(), True)
    return old


def _by_series(spark: SparkSession, path: str, schema: StructType, buckets: int) -> DataFrame:
    """A bucketed table through this session's catalog, which knows it only if this session wrote it."""
    name = writers.series_table(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(SERIE)}) "
            f"SORTED BY ({', '.join(SERIE_DIA)}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _children(spark: SparkSession, path: str) -> list[str]:
    files, target = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def publish(spark: SparkSession, folder: str, name: str, body: str) -> None:
    """Put a whole file in place under a name that must be new."""
    jvm = spark._jvm
    files, aside = _files(spark, f"{folder}/.{uuid.uuid4().hex}")
    stream = files.create(aside, True)
    try:
        stream.write(bytearray(body.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.makeQualified(aside).toUri(), spark._jsc.hadoopConfiguration()
    )
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(
            files.makeQualified(aside), files.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")), no_options
        )
    except (Py4JJavaError, PySparkException) as error:
        files.delete(aside, False)
        if "FileAlreadyExists" in str(error):
            raise Conflict(f"{folder}/{name} exists") from error
        raise
