"""Every registered query against its SQL twin, and the shape of its plan."""

import os

import pytest
from crosscheck import compare, connect

from kpimill.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
# operators that would run Python per row, or pair all rows of two sides
BANNED = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def executions(spark, after):
    """Last id, and the plans of every execution with a greater id than ``after``, those of loads and writes included."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    last, plans = after, []
    for i in range(found.size() - 1, -1, -1):
        one = found.apply(i)
        number = one.executionId()
        last = max(last, number)
        if number <= after:
            break
        plans.append(one.physicalPlanDescription())
        if after < 0:
            break
    return last, plans


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    before, _ = executions(spark, -1)
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0
    _, plans = executions(spark, max(before, 0))
    assert plans
    assert not [b for p in plans for b in BANNED if b in p]


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns[:3] == ["period", "table_name", "report_date"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
