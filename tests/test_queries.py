"""Every registered query against its SQL on the smallest test data."""

import re
from pathlib import Path

import pytest
from compare import TABLES, connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from shelfmend.bindings.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoopJoin|EvalPython|MapInPandas", plan)
    found, _ = differences(df, con, oracle_sql()[name])
    assert found == []


SKEWED = (
    "reconcile_blocked", "dup_picks", "surplus_tasks", "merge_lots", "move_fitting", "close_store_po_per_order",
    "classify_cut", "orphan_stock", "dup_log", "claim_batch",
)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, con):
    """The test data with a third of all rows on one item, supplier, customer or user."""
    folder = tmp_path_factory.mktemp("skewed")
    columns = {
        "lineitem": "* REPLACE (CASE WHEN l_linenumber < 3 THEN 7 ELSE l_partkey END AS l_partkey,"
        " CASE WHEN l_quantity < 17 THEN 3 ELSE l_suppkey END AS l_suppkey)",
        "orders": "* REPLACE (CASE WHEN o_totalprice < 170000 THEN 5 ELSE o_custkey END AS o_custkey)",
        "events": "* REPLACE (CASE WHEN value < 20 THEN 8 ELSE user_id END AS user_id)",
    }
    for table in TABLES.split():
        con.execute(f"COPY (SELECT {columns.get(table, '*')} FROM {table}) TO '{folder}/{table}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", SKEWED)
def test_query_on_skewed_data(spark, skewed, name):
    found, rows = differences(queries()[name](spark, skewed), connect(skewed), oracle_sql()[name])
    assert found == [] and rows > 0
