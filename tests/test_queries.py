"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_oracle import TABLES, compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return c


def no_product(df):
    """No query may fall back to a cross join, which grows with the product of two tables, or to Python row by row."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan, operator


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict, rows, _, _, note = compare(spark, con, name, QUERIES[name], SQL.get(name), FOLDER, look=no_product)
    assert verdict in ("ok", "rows"), f"{verdict}: {note}"


def test_entry(spark):
    assert entry(spark).count() > 0


def test_filter_and_columns_reach_the_scan(spark):
    plan = QUERIES["scan_parquet"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan
    assert "l_comment" not in plan and "l_extendedprice" not in plan
