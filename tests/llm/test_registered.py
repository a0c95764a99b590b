"""Registered operator queries against their DuckDB statements, and the driver's contract."""

import importlib

import pytest

from mercatura.llm.registry import QUERIES, SQL
from oracles.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) is None


def test_all_operators_and_the_pipeline_are_registered():
    names = importlib.import_module("__spark_entry__").queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
