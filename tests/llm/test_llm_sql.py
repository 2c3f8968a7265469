"""Queries that SQL can express, against it."""

import pytest

from compare import connect, difference
from martkeeper.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, folder, name):
    with connect(folder) as con:
        df = registry.queries()[name](spark, folder)
        assert difference(df, con, registry.oracle_sql()[name]) == ""


def test_every_operator_has_a_query():
    names = [n.split("_")[0] for n in registry.queries()]
    assert names == [f"op{n}" for n in range(1, 14)]
