"""Every registered query against its SQL on the smallest tables, and without key-less joins."""

import pytest

from __spark_entry__ import entry
from catalog.oracle import SQL
from catalog.queries import QUERIES
from tools.compare import compare, connect

SF = "/root/testdata/sf0.001"
# Too few days per station at this size for the 100-day wind gate.
EMPTY_HERE = {"high_wind_events"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry_runs(spark):
    assert entry(spark).count() == 36


def test_every_query_has_a_check():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    problem = compare(df, con, name)
    assert problem is None or (name in EMPTY_HERE and problem == "EMPTY")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert unwanted not in plan
