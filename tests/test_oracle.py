"""Every registered query against its SQL, and its plan against the rules."""

import pytest

import __spark_entry__ as entry
from workload.compare import compare, duck
from workload.registry import ORACLES, QUERIES

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "SinglePartition, REPARTITION"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_registry_is_complete():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, sf_dir, name):
    plans = []

    def run(session, folder):
        df = entry.queries()[name](session, folder)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    ok, note = compare(spark, con, name, run, entry.oracle_sql()[name], sf_dir)
    assert ok, note
    found = [word for word in FORBIDDEN if word in plans[0]]
    assert not found, f"{found} in plan:\n{plans[0][:3000]}"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["skill", "count"] and df.count() == 15
