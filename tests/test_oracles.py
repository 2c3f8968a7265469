"""Every registered query against its SQL oracle, and rules that all plans keep."""

import re

import pytest

import __spark_entry__ as entry_module
from compare import connect, difference
from martkeeper.plans.oracles import oracles
from martkeeper.plans.registry import queries as registered

QUERIES, ORACLES = registered(), oracles()


@pytest.fixture(scope="module")
def con(folder):
    with connect(folder) as c:
        yield c


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    assert difference(df, con, ORACLES[name]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert not re.search(r"(Batch|Arrow)EvalPython|InPandas", plan)


def test_entry_runs(spark, folder):
    df = entry_module.entry(spark)
    assert df.columns == ["Channel", "Device Type", "avg_cycle_days", "patient_count"]
    df.collect()
