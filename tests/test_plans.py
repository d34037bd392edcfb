"""Physical plans that must hold at scale, whatever the size of the test tables."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as contract
from anaquel.operators import silver, star
from anaquel.session import stage
from harness.derive import domain

SF_DIR = contract.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

# Their plans read the files a stream or a sink has just written.
FILE_QUERIES = ("scan_", "sink_", "stream_", "lineage_", "risk_partitioned")
# The corpus operators run jobs and Python of their own; ``tests/llm`` looks at them.
CORPUS = re.compile(r"op\d+_|pipeline$")
LAZY = [n for n in contract.queries() if not n.startswith(FILE_QUERIES) and not CORPUS.match(n)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_query_multiplies_rows_by_a_cross_join(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "InPandas" not in plan


def exchanges_above_scan(plan, table):
    """Shuffles on the way from a scan of ``table`` to the top of the plan."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and table in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    found, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            if "Exchange" in line and "Broadcast" not in line:
                found.append(line.strip())
    return found


@pytest.mark.parametrize("name", ["forecast_daily", "features", "labels_next7", "safety_stock"])
def test_work_by_series_reads_the_stored_fact_without_a_shuffle(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert exchanges_above_scan(plan, "anaquel_") == []


def test_dense_fact_shuffles_series_not_cells(spark):
    d = domain(spark, SF_DIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = star.dense_fact(d.calendar, d.stores, d.catalog, d.daily, d.inventory)
        plan = plan_of(fact)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    grid = next(i for i, line in enumerate(lines) if "Generate" in line and "[fecha" in line)
    above = [line for line in lines[:grid] if "Exchange" in line]
    assert above == []
    assert plan.count("SortMergeJoin") == 3  # daily totals, inventory, and the live feed under it


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(contract.queries()["feed_freshness"](spark, SF_DIR))
    lineitem = next(p for p in plan.split("FileScan")[1:] if "lineitem" in p)
    assert "EqualTo(l_linestatus,F)" in lineitem
    assert "l_quantity" not in lineitem.split("ReadSchema")[1]


def test_short_list_is_unfolded_whichever_side_it_is(spark, monkeypatch):
    d = domain(spark, SF_DIR)
    expected = sorted(map(tuple, star._all_series(d.stores, d.catalog).collect()))
    assert len(expected) == 5 * d.catalog.count()
    # Both lists over the limit, and several blocks.
    monkeypatch.setattr(star, "fits", lambda df, *_: False)
    monkeypatch.setattr(star, "CLAVES_POR_BLOQUE", 2)
    for stores, catalog in ((d.stores, d.catalog), (d.stores.limit(3), d.catalog.limit(2))):
        blocked = star._all_series(stores, catalog)
        plan = plan_of(blocked)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert blocked.distinct().count() == stores.count() * catalog.count() == blocked.count()
    assert sorted(map(tuple, star._all_series(d.stores, d.catalog).collect())) == expected


def test_stored_inventory_does_not_move(spark):
    """The live feed goes to the history's buckets; nothing is exchanged above the history's scan."""
    d = domain(spark, SF_DIR)
    live = stage(d.inventory_live, "viva")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inventory = silver.merge_inventory(d.inventory_history, live, placed=True)
        plan = plan_of(inventory)
        fact = plan_of(star.dense_fact(d.calendar, d.stores, d.catalog, d.daily, inventory))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(tienda_id") == 1
    assert "Union" not in plan and "Window" in plan
    # Above it the fact shuffles its series and the daily totals only.
    assert fact.count("Exchange hashpartitioning(tienda_id") <= 4
