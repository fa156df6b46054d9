"""Every registered query against SQL on the same tables."""

import pytest

import __spark_entry__ as contract
from postbud.queries import catalog, oracles
from tests.compare import connect, difference, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"

# Rows through Python, and joins that pair everything with everything.
UNWANTED = (
    "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct",
    "BroadcastNestedLoopJoin",
)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(catalog.queries()) == set(oracles.oracle_sql())
    assert set(catalog.queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]
    assert difference(spark_rows(df), duck_rows(duck, contract.oracle_sql()[name])) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["rad", "region", "suffix"] and len(df.columns) == 40
    assert df.count() > 0
