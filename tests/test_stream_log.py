"""The log source, the preferred delivery, latency by minute and replay of quarantined messages."""

from __future__ import annotations

import datetime as dt
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from anaquel import schemas
from anaquel.sources import readers
from anaquel.streaming import ingest, log, replay, settle
from tests.conftest import rows
from tests.test_streaming import sale

START = dt.datetime(2024, 1, 1, 12)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def put(spark, path, *messages, **options):
    """Messages as (text, partition, offset, second of arrival)."""
    sent = [(m[0], m[1], m[2], at(m[3]) if m[3] is not None else None) for m in messages]
    df = spark.createDataFrame(sent, "value string, partition int, offset bigint, timestamp timestamp")
    return log.append(df, str(path), **options)


def read(spark, path, out, starting="earliest"):
    """What a stream over the log delivers until its end, in (partition, offset) order."""
    query = (
        log.messages(spark, str(path), starting).writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/control").trigger(availableNow=True).start(f"{out}/datos")
    )
    query.awaitTermination()
    seen = spark.read.schema(log.SCHEMA).parquet(f"{out}/datos").withColumn("value", F.col("value").cast("string"))
    return rows(seen.orderBy("partition", "offset"), "value", "partition", "offset")


def sales(spark, path):
    return ingest.parse_sales(log.messages(spark, str(path)), arrival=F.col("timestamp"))


def land(spark, stream, out, mode="append"):
    replay.drain(replay.land_batches(stream, f"{out}/datos", f"{out}/control", mode, seconds=0))
    return replay.read_batches(spark, f"{out}/datos", stream.schema)


def test_restart_goes_on_and_new_checkpoint_starts_again(spark, tmp_path):
    put(spark, tmp_path / "log", ("a", 0, 0, 0), ("b", 1, 0, 1), ("c", 0, 1, 2))
    assert read(spark, tmp_path / "log", tmp_path / "x") == [("a", 0, 0), ("c", 0, 1), ("b", 1, 0)]
    put(spark, tmp_path / "log", ("d", 0, 5, 3), (None, 2, 7, 3))  # a gap, a new partition, no text
    whole = [("a", 0, 0), ("c", 0, 1), ("d", 0, 5), ("b", 1, 0), (None, 2, 7)]
    assert read(spark, tmp_path / "log", tmp_path / "x") == whole  # each once
    assert read(spark, tmp_path / "log", tmp_path / "x") == whole  # nothing new
    assert read(spark, tmp_path / "log", tmp_path / "y") == whole


def test_start_at_offsets_inside_a_segment(spark, tmp_path):
    put(spark, tmp_path / "log", *((f"m{n}", n % 2, n, n) for n in range(100)), segment_rows=7)
    got = read(spark, tmp_path / "log", tmp_path / "x", {0: 90, 1: 95})
    assert [o for _, p, o in got if p == 0] == [90, 92, 94, 96, 98]
    assert [o for _, p, o in got if p == 1] == [95, 97, 99]
    assert len(read(spark, tmp_path / "log", tmp_path / "y", {1: 51})) == 50 + 25


def test_latest_skips_what_is_there(spark, tmp_path):
    put(spark, tmp_path / "log", ("a", 0, 0, 0))
    start = log.LogReader(str(tmp_path / "log"), "latest").initialOffset()
    assert start == {"0": 1}
    put(spark, tmp_path / "log", ("b", 0, 1, 0))
    assert read(spark, tmp_path / "log", tmp_path / "x", start) == [("b", 0, 1)]


def test_log_without_messages(spark, tmp_path):
    assert put(spark, tmp_path / "log") == -1
    assert log.LogReader(str(tmp_path / "nowhere"), "earliest").latestOffset() == {}
    assert put(spark, tmp_path / "log", ("a", 0, 0, 0)) == 0
    assert put(spark, tmp_path / "log", ("b", 0, 1, 0)) == 1


@pytest.mark.parametrize("bad", [("x", None, 3, 0), ("x", 0, None, 0), ("x", 0, 1, 0)])
def test_messages_without_a_new_place_are_refused_whole(spark, tmp_path, bad):
    put(spark, tmp_path / "log", ("a", 0, 0, 0), ("b", 0, 1, 0))
    with pytest.raises(ValueError):
        put(spark, tmp_path / "log", ("good", 1, 0, 0), bad)
    assert len(read(spark, tmp_path / "log", tmp_path / "x")) == 2


def test_batch_plans_only_segments_it_needs(spark, tmp_path):
    for n in range(4):
        put(spark, tmp_path / "log", (f"m{n}", 0, n, n))
    reader = log.LogReader(f"file:{tmp_path}/log", "earliest")
    parts = reader.partitions({"0": 2}, {"0": 3})
    assert [(p.start, p.end) for p in parts] == [(2, 3)]
    batch = next(reader.read(parts[0]))
    assert batch.column("value").to_pylist() == [b"m2"] and batch.column("partition").to_pylist() == [0]


def test_preferred_delivery_wins_whenever_it_arrives(spark, tmp_path):
    early = "2024-01-01T09:00:00Z"
    put(
        spark, tmp_path / "log",
        (sale("a"), 0, 0, 0), (sale("a", momento=early), 1, 0, 300), (sale("a"), 0, 1, 600),  # chain of 5 minutes
        (sale("b"), 0, 2, 10), (sale("b"), 1, 1, 20),  # equal: the earlier arrival
        (sale("c", momento=None), 0, 3, 30), (sale("c"), 1, 2, 30),  # no time of sale comes first
        (sale("d"), 0, 4, 0), (sale("d", momento=early), 1, 3, 5000),  # too far apart: both
        (sale(None), 0, 5, 0), (sale(None), 0, 6, 0), ("{broken", 0, 7, 0), ("{broken", 0, 8, 0),
        (sale("later"), 0, 9, 90_000),
    )
    got = land(spark, settle.preferred_deliveries(sales(spark, tmp_path / "log")), tmp_path / "x")
    named = got.where("venta_id is not null").orderBy("venta_id", "recibido")
    assert rows(named, "venta_id", "particion", "offset_kafka", "entregas") == [
        ("a", 1, 0, 3), ("b", 0, 2, 2), ("c", 0, 3, 2), ("d", 0, 4, 1), ("d", 1, 3, 1),
    ]
    other = got.where("venta_id is null").orderBy("offset_kafka")
    assert rows(other, "offset_kafka", "estado", "entregas") == [
        (5, "ok", 1), (6, "ok", 1), (7, "cuarentena", 1), (8, "cuarentena", 1),
    ]


def test_preferred_agrees_with_the_batch_rule_over_batches(spark, tmp_path):
    """State carries a sale over batches: the winner of three restarts is the winner of all deliveries."""
    for n, second in enumerate((5, 2, 9)):
        put(spark, tmp_path / "log", (sale("a", momento=f"2024-01-01T10:00:0{second}Z"), 0, n, 60 * n))
        land(spark, settle.preferred_deliveries(sales(spark, tmp_path / "log")), tmp_path / "x")
    put(spark, tmp_path / "log", ("", 0, 3, 90_000))
    got = land(spark, settle.preferred_deliveries(sales(spark, tmp_path / "log")), tmp_path / "x")
    assert rows(got, "venta_id", "offset_kafka", "entregas") == [("a", 1, 3)]


def test_hot_sale_is_settled_before_the_shuffle(spark, tmp_path):
    put(spark, tmp_path / "log", *((sale("a"), 0, n, n % 60) for n in range(5000)), ("", 0, 5000, 90_000))
    stream = settle.preferred_deliveries(sales(spark, tmp_path / "log"))
    query = replay.land_batches(stream, f"{tmp_path}/d", f"{tmp_path}/c", seconds=0)
    query.processAllAvailable()
    plan = query._jsq.explainInternal(False)
    query.stop()
    got = replay.read_batches(spark, f"{tmp_path}/d", stream.schema)
    assert rows(got, "offset_kafka", "entregas") == [(0, 5000)]
    assert plan.count("MergingSessions") >= 2 and plan.rindex("MergingSessions") > plan.rindex("Exchange")


def test_latency_by_minute_keeps_the_last_state(spark, tmp_path):
    def moment(seconds):
        return at(seconds).isoformat() + "Z"

    put(
        spark, tmp_path / "log",
        (sale("a", momento=moment(-30)), 0, 0, 0), (sale("b", momento=moment(0)), 0, 1, 59),
        (sale("c", momento=moment(60)), 0, 2, 60), ("{broken", 0, 3, 1), (sale("d", momento=None), 0, 4, 61),
    )
    first = land(spark, settle.latency_by_minute(sales(spark, tmp_path / "log")), tmp_path / "x", "update")
    assert settle.current_minutes(first).count() == 2
    put(spark, tmp_path / "log", (sale("e", momento=moment(61)), 0, 5, 62))  # the second minute again
    stream = settle.latency_by_minute(sales(spark, tmp_path / "log"))
    minutes = settle.current_minutes(land(spark, stream, tmp_path / "x", "update"))
    assert rows(minutes.orderBy("minuto")) == [
        (at(0), 2, 2, 89_000_000, 59_000_000, at(0)), (at(60), 3, 2, 1_000_000, 1_000_000, at(61)),
    ]
    assert rows(settle.latency_total(minutes)) == [(5, 22.5, 59.0, at(61))]
    assert rows(settle.latency_total(minutes.limit(0))) == [(0, None, None, None)]


def broken_store(spark, tmp_path):
    put(
        spark, tmp_path / "log",
        (sale("a"), 0, 0, 0), ("x" + sale("b"), 0, 1, 1), ("x" + sale("c"), 1, 1, 2), ("nothing", 1, 2, 3),
    )
    path = str(tmp_path / "datos")
    ingest.land(sales(spark, tmp_path / "log"), path, str(tmp_path / "control"), available_now=True).awaitTermination()
    return path, str(tmp_path / "reparadas")


def mend(text):
    return F.regexp_replace(text, "^x", "")


def go(spark, landed, mended, checkpoint, how=mend):
    replay.replay(spark, landed, mended, str(checkpoint), how, available_now=True).awaitTermination()
    return sorted(rows(replay.mended_sales(spark, mended), "venta_id", "particion", "offset_kafka", "recibido"))


def test_replay_adds_nothing_the_second_time(spark, tmp_path):
    landed, mended = broken_store(spark, tmp_path)
    both = [("b", 0, 1, at(1)), ("c", 1, 1, at(2))]
    only_b = lambda text: F.regexp_replace(text, '^x(.*"b")', "$1")
    assert go(spark, landed, mended, tmp_path / "c1", only_b) == both[:1]
    assert go(spark, landed, mended, tmp_path / "c1", only_b) == both[:1]
    assert go(spark, landed, mended, tmp_path / "c2") == both  # a new checkpoint and a better repair
    assert go(spark, landed, mended, tmp_path / "c3") == both
    open_ = replay.still_open(ingest.quarantined(spark, landed), replay.mended_sales(spark, mended))
    assert rows(open_, "mensaje") == [("nothing",)]
    whole = readers.read_stream_landed(spark, landed).unionByName(replay.mended_sales(spark, mended))
    assert whole.columns == schemas.VENTA_STREAM.fieldNames() and whole.count() == 3


def test_batch_that_runs_again_replaces_its_own_rows(spark, tmp_path):
    landed, mended = broken_store(spark, tmp_path)
    first = go(spark, landed, mended, tmp_path / "c1")
    for commit in (tmp_path / "c1" / "commits").iterdir():  # as if it had died before its commit
        commit.unlink()
    assert go(spark, landed, mended, tmp_path / "c1") == first
    assert len(first) == 2


def test_nothing_in_quarantine(spark, tmp_path):
    put(spark, tmp_path / "log", (sale("a"), 0, 0, 0))
    path = str(tmp_path / "datos")
    ingest.land(sales(spark, tmp_path / "log"), path, str(tmp_path / "control"), available_now=True).awaitTermination()
    assert go(spark, path, str(tmp_path / "reparadas"), tmp_path / "c1") == []


def test_missing_arrival_is_now(spark, tmp_path):
    put(spark, tmp_path / "log", (sale("a"), 0, 0, None))
    path = str(tmp_path / "datos")
    ingest.land(sales(spark, tmp_path / "log"), path, str(tmp_path / "control"), available_now=True).awaitTermination()
    (row,) = readers.read_stream_landed(spark, path).collect()
    assert row.recibido is not None and json.loads(sale("a"))["venta_id"] == row.venta_id


def test_a_task_holds_a_batch_of_a_segment_not_all_of_it(tmp_path):
    """One row group of 60 MB is read page by page, and only the offsets asked for are sent."""
    n = 300_000
    pq.write_table(
        pa.table({
            "value": pa.array([f"{i:07d}".encode() * 28 for i in range(n)], pa.binary()),
            "offset": pa.array(range(n), pa.int64()),
            "timestamp": pa.array(range(n), pa.timestamp("us")),
        }),
        f"{tmp_path}/segment.parquet", row_group_size=n, use_dictionary=False,
    )
    before, most, offsets = pa.total_allocated_bytes(), 0, []
    reader = log.LogReader(str(tmp_path), "earliest")
    for batch in reader.read(log.Segment(f"{tmp_path}/segment.parquet", 2, 5, n - 5)):
        most = max(most, pa.total_allocated_bytes() - before)
        assert set(batch.column("partition").to_pylist()) == {2}
        offsets += batch.column("offset").to_pylist()
    assert offsets == list(range(5, n - 5))
    assert most < 24 << 20


def test_row_groups_without_a_wanted_offset_are_not_read(tmp_path):
    table = pa.table({
        "value": pa.array([b"x"] * 100, pa.binary()), "offset": pa.array(range(100), pa.int64()),
        "timestamp": pa.array([None] * 100, pa.timestamp("us")),
    })
    pq.write_table(table, f"{tmp_path}/segment.parquet", row_group_size=10)
    meta = pq.read_metadata(f"{tmp_path}/segment.parquet")
    asked = log.Segment(f"{tmp_path}/segment.parquet", 0, 35, 52)
    assert [i for i in range(10) if log._may_hold(meta.row_group(i), asked)] == [3, 4, 5]
    (got,) = [b.column("offset").to_pylist() for b in log.LogReader("", "earliest").read(asked)]
    assert got == list(range(35, 52))
