"""Every registered query against DuckDB on the same Parquet files."""

import importlib

import pytest

from oracles.compare import connect, difference
from oracles.registry import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", REGISTRY)
def test_query_equals_sql(spark, con, name):
    entry = REGISTRY[name]
    assert entry.sql is not None
    assert difference(entry.run(spark, FOLDER), con, entry.sql) is None


def test_driver_contract(spark):
    module = importlib.import_module("__spark_entry__")
    assert set(REGISTRY) <= set(module.queries())
    assert set(REGISTRY) <= set(module.oracle_sql()) <= set(module.queries())
    result = module.entry(spark)
    assert result.count() == 15 and "corridor" in result.columns
