"""Retail inputs derived from the given tables: what moves, and what is stored on the way."""

from __future__ import annotations

import datetime as dt

import pytest

from harness.derive import Domain
from tests.conftest import rows


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Two brands, two regions; the third order line of part 2 comes twice, and one has an unknown part."""
    root = str(tmp_path_factory.mktemp("tablas"))

    def save(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{root}/{name}.parquet")

    save("nation", [(1, "A", 0), (2, "B", 4)], "n_nationkey int, n_name string, n_regionkey int")
    save("supplier", [(10, "S", 1, 0.0), (11, "T", 2, 0.0)],
         "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    save("part", [(1, "P", "Brand#11", "t", 1, 10.0), (2, "Q", "Brand#22", "t", 1, 2.5)],
         "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    lines = [
        (101, 1, 10, 1, 3.0, "F", 1), (102, 2, 11, 1, 4.0, "F", 2), (102, 2, 11, 1, 4.0, "F", 2),
        (103 + 97, 9, 11, 1, 4.0, "F", 2), (204, 1, 11, 2, 5.0, "O", 4),
    ]
    save("lineitem", [
        (k, p, s, n, q, 1.0, 0.0, 0.0, "N", status, dt.datetime(2001, 1, d)) for k, p, s, n, q, status, d in lines
    ], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
       "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
       "l_shipdate timestamp")
    save("orders", [(101, 1, "F", 1.0, dt.datetime(2001, 1, 1))],
         "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp")
    return root


def test_order_lines_stay_where_they_are_for_small_dimensions(spark, sf_dir):
    """The planner's own limit for broadcasts, which guesses sizes, does not decide it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        history = Domain(spark, sf_dir).history
        plan = history._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert sorted(rows(history, "venta_id", "tienda_id", "sku", "importe")) == [
        ("101-1", "T01", "Brand#11", 30.0), ("102-1", "T05", "Brand#22", 10.0), ("102-1", "T05", "Brand#22", 10.0),
    ]


def test_daily_totals_need_no_stored_sales(spark, sf_dir):
    d = Domain(spark, sf_dir)
    assert d.daily.inputFiles() and "sales" not in d.__dict__
    expected = [("Brand#11", 3, 30.0), ("Brand#11", 5, 50.0), ("Brand#22", 4, 10.0)]
    assert sorted(rows(d.daily, "sku", "unidades", "importe")) == expected
    for first in ("sales", "feeds"):  # from the stored sales or feeds, if there are any: the same
        other = Domain(spark, sf_dir)
        getattr(other, first)
        assert sorted(rows(other.daily, "sku", "unidades", "importe")) == expected
