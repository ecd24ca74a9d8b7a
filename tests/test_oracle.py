"""Every registered query against its DuckDB statement on the smallest tables, and the
shape of its plan."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.compare import compare, database


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


def test_every_query_has_an_oracle():
    assert set(entry.REGISTRY) == set(entry.ORACLES)


@pytest.mark.parametrize("name", sorted(entry.REGISTRY))
def test_query_matches_oracle(spark, con, name):
    df = entry.REGISTRY[name](spark, SMALL)
    ok, note = compare(spark, con, SMALL, name, lambda *_: df, entry.ORACLES[name])
    assert ok, note
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
