"""Running suites of checks over tables and models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame

from mercatura.operators.quality import run_checks
from mercatura.session import shuffles_freed, stage

Suite = Mapping[str, Sequence[dict]]


def run_suite(
    suite: Suite, tables: Mapping[str, DataFrame], parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The results of every check of every table, as one frame."""
    results = [run_checks(tables[name], name, checks, parents) for name, checks in suite.items()]
    return reduce(DataFrame.unionByName, results)


def check_models(
    models, suite: Suite, parents: Mapping[str, DataFrame] | None = None, parallel: int = 4
) -> DataFrame:
    """Check models that are not stored yet.

    A model is read once per uniqueness check, so the columns under test are
    computed once and staged; several models at a time, to keep executors busy. Shuffle files
    go with the query that wrote them, so those of one model are not kept until all are done.
    """

    def checked(name: str) -> DataFrame:
        columns = {check["kwargs"]["column"] for check in suite[name]}
        return stage(getattr(models, name).select(*sorted(columns)), name)

    # Around all threads, as the setting is the session's.
    with shuffles_freed(models.raw.orders.sparkSession), ThreadPoolExecutor(parallel) as pool:
        tables = dict(zip(suite, pool.map(checked, suite)))
    return run_suite(suite, tables, parents)
