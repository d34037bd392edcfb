"""Versions of tables: publishing, pinned readers, periods, conflicts, clean-up."""

from __future__ import annotations

import pytest

from anaquel.sources import snapshots
from tests.conftest import day, rows


def days(spark, *numbers, tag="x"):
    return spark.createDataFrame([(day(n), tag) for n in numbers], "fecha date, t string")


def test_nothing_is_visible_before_the_commit(spark, tmp_path):
    root = str(tmp_path)
    draft = snapshots.begin(spark, root)
    draft.save("a", spark.range(3))
    assert snapshots.latest(spark, root) is None
    draft.commit()
    assert snapshots.latest(spark, root).table(spark, "a").count() == 3


def test_readers_stay_on_their_version(spark, tmp_path):
    root = str(tmp_path)
    frames = []
    for n in (3, 5):
        draft = snapshots.begin(spark, root)
        frames.append(draft.save("a", spark.range(n)))
        draft.commit()
    assert [f.count() for f in frames] == [3, 5]
    assert snapshots.at(spark, root, 1).table(spark, "a").count() == 3
    assert snapshots.versions(spark, root) == [1, 2]


def test_second_writer_on_the_same_version_is_refused(spark, tmp_path):
    root = str(tmp_path)
    one, two = snapshots.begin(spark, root), snapshots.begin(spark, root)
    one.save("a", spark.range(1))
    two.save("a", spark.range(2))
    one.commit()
    with pytest.raises(snapshots.Conflict):
        two.commit()
    assert snapshots.latest(spark, root).table(spark, "a").count() == 1
    assert snapshots.versions(spark, root) == [1]


def test_periods_are_replaced_one_by_one(spark, tmp_path):
    root = str(tmp_path)
    draft = snapshots.begin(spark, root)
    draft.save_periods("d", days(spark, 1, 2, 40, 70))
    first = draft.commit()
    assert first.periods("d") == ["2024-01", "2024-02", "2024-03"]
    draft = snapshots.begin(spark, root)
    draft.save_periods("d", days(spark, 41, 42, tag="new"), periods=["2024-02", "2024-03"])
    second = draft.commit()
    assert sorted(rows(second.table(spark, "d"))) == [
        (day(1), "x"), (day(2), "x"), (day(41), "new"), (day(42), "new")
    ]
    assert rows(second.table(spark, "d", ["2024-03", "2030-01"])) == []
    assert first.table(spark, "d").count() == 4
    # January was not written again.
    assert second.entries["d"].periods["2024-01"] == first.entries["d"].periods["2024-01"]


def test_series_tables_open_in_a_session_that_did_not_write_them(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame(
        [(f"T{i % 3}", f"S{i % 5}", day(i + 1), i) for i in range(30)],
        "tienda_id string, sku string, fecha date, n int",
    )
    draft = snapshots.begin(spark, root)
    draft.save_by_series("s", df, 4)
    version = draft.commit()
    name = snapshots.writers.series_table(version.path("s"))
    spark.sql(f"DROP TABLE {name}")
    got = version.table(spark, "s")
    assert sorted(rows(got, "tienda_id", "sku", "fecha", "n")) == sorted(rows(df))
    plan = got.groupBy("tienda_id", "sku").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_old_versions_go_and_shared_folders_stay(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        draft = snapshots.begin(spark, root)
        draft.save("a", spark.range(n))
        draft.save_periods("d", days(spark, 1 + 31 * n), periods=[f"2024-0{n + 1}"] if n else None)
        draft.commit()
    abandoned = snapshots.begin(spark, root)
    abandoned.save("a", spark.range(9))
    assert snapshots.expire(spark, root, keep=2, abandoned_hours=0) == [1, 2]
    assert snapshots.versions(spark, root) == [3, 4]
    last = snapshots.latest(spark, root)
    assert last.table(spark, "d").count() == 4  # three periods lie in folders of earlier versions
    assert last.table(spark, "a").count() == 3
    assert snapshots.at(spark, root, 3).table(spark, "a").count() == 2
    assert not (tmp_path / abandoned.folder).exists()


def test_notes_reach_the_next_writer(spark, tmp_path):
    root = str(tmp_path)
    draft = snapshots.begin(spark, root)
    draft.notes["marca"] = "2024-01-05"
    draft.save("a", spark.range(1))
    draft.commit()
    draft = snapshots.begin(spark, root)
    assert draft.base.notes == {"marca": "2024-01-05"}
    draft.keep("a")
    assert draft.commit().table(spark, "a").count() == 1
