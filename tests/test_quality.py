"""Checks compiled to aggregates, the gate, the audit record and freshness."""

import datetime as dt

import pytest

from mercatura.operators import quality as q
from mercatura.session import staged_path


@pytest.fixture
def table(spark):
    rows = [(1, "a", 5.0), (2, "b", 0.0), (2, None, -1.0), (None, "z", None)]
    return spark.createDataFrame(rows, "id int, kind string, price double")


def _run(table, check, parents=None):
    row = q.run_checks(table, "t", [check], parents).first()
    return row.failed_rows, row.observed_value, row.success


def _between(**kwargs):
    return {"expectation_type": q.BETWEEN, "kwargs": {"column": "price", **kwargs}}


def test_row_checks(table):
    assert _run(table, q.not_null("id")) == (1, None, False)
    assert _run(table, q.accepted_values("kind", ["a", "b"])) == (1, None, False)
    assert _run(table, q.accepted_values("kind", ["a", "b", "z"])) == (0, None, True)
    assert _run(table, _between(min_value=0)) == (1, None, False)
    assert _run(table, _between(min_value=0, strict_min=True)) == (2, None, False)
    assert _run(table, _between(min_value=-1, max_value=5)) == (0, None, True)
    assert _run(table, _between(max_value=5, strict_max=True)) == (1, None, False)


def test_row_count(table):
    check = lambda low, high: {
        "expectation_type": q.ROW_COUNT,
        "kwargs": {"min_value": low, "max_value": high},
    }
    assert _run(table, check(4, None)) == (None, 4.0, True)
    assert _run(table, check(5, None)) == (None, 4.0, False)
    assert _run(table, check(None, 3)) == (None, 4.0, False)


def test_uniqueness_ignores_nulls(table):
    assert _run(table, q.unique("id")) == (2, None, False)
    assert _run(table, q.unique("kind")) == (0, None, True)
    share = {
        "expectation_type": q.UNIQUE_SHARE,
        "kwargs": {"column": "id", "min_value": 0.6, "max_value": 1.0},
    }
    failed, observed, ok = _run(table, share)
    assert failed is None and observed == pytest.approx(2 / 3) and ok


def test_relationship_counts_rows_and_allows_null(spark, table):
    parent = spark.createDataFrame([(1,), (1,)], "key int")
    check = q.relationship("id", "p", "key")
    assert _run(table, check, {"p": parent}) == (2, None, False)
    assert _run(table.where("id = 1"), check, {"p": parent}) == (0, None, True)


def test_empty_table_passes_row_checks(table):
    empty = table.limit(0)
    checks = [q.not_null("id"), q.unique("id"), q.accepted_values("kind", ["a"])]
    assert [r.success for r in q.run_checks(empty, "t", checks).collect()] == [True] * 3


def test_row_checks_share_one_pass(table):
    checks = [q.not_null("id"), q.not_null("kind"), _between(min_value=0)]
    plan = q.run_checks(table, "t", checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_failures_gate_and_audit(spark, table):
    results = q.run_checks(table, "t", [q.not_null("id"), q.unique("id"), q.not_null("kind")])
    now = dt.datetime(2024, 1, 1)
    failed = q.failures(results, now)
    assert {(r.table_name, r.run_time, r.total_failed, r.observed_value) for r in failed.collect()} == {
        ("t", now, 3, "N/A")
    }
    path = staged_path(spark, "audit")
    for _ in range(2):
        q.append_failures(failed, path)
    assert spark.read.parquet(path).where("table_name = 't'").count() == 6
    with pytest.raises(q.QualityGateError, match="3 failed checks.*t: "):
        q.require_passed(results)
    q.require_passed(q.run_checks(table, "t", [q.unique("kind")]))


def test_freshness_limits(spark):
    loaded = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(loaded,), (None,)], "at timestamp_ntz")

    def status(days, seconds=0):
        now = loaded + dt.timedelta(days=days, seconds=seconds)
        return q.check_freshness(df, "t", "at", now, 3, 5).first().status

    assert [status(3), status(3, 1), status(5), status(5, 1)] == ["pass", "warn", "warn", "error"]
    empty = q.check_freshness(df.limit(0), "t", "at", loaded, 3, 5).first()
    assert empty.status == "error"
