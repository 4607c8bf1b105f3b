"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks import bind
from checks.compare import connect, difference

FOLDER = entry.SMOKE
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", bind.QUERIES)
def test_query(spark, database, name):
    found = bind.QUERIES[name](spark, FOLDER).toPandas()
    sql = bind.ORACLE.get(name)
    if sql is None:
        assert len(found) > 0
    else:
        assert difference(found, database.execute(sql).df()) is None


def test_entry(spark):
    flagship = entry.entry(spark)
    assert flagship.count() > 0
    assert {"UNSPSC_COMMODITY", "ORDER_AMOUNT", "PO_ITEM_COUNT"} <= set(flagship.columns)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_cross_joins(spark):
    for name in ("network_monthly", "clean_items", "join_sources", "legal_codes", "split_known"):
        plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["scan_projected"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "l_comment" not in plan
    window = entry.queries()["scan_window"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderdate" in window and "LessThanOrEqual(o_orde" in window
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in window
