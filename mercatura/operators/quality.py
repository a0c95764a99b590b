"""Declarative checks compiled to Spark aggregates.

A check is plain data: ``{"expectation_type": ..., "kwargs": {...}}``. All checks
that look at single rows share one aggregation over the table. A uniqueness
check needs the rows per value, a relationship the values without a parent; both
count per value first, so a frequent value is combined on the map side. A share of distinct values
with ``"approximate": true`` comes from a sketch in the shared aggregation instead.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.functions.calendar import at
from mercatura.operators.distinct import distinct_count

ROW_COUNT = "expect_table_row_count_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
UNIQUE_SHARE = "expect_column_proportion_of_unique_values_to_be_between"
RELATIONSHIP = "relationships"

RESULT_COLUMNS = (
    "table_name",
    "check_no",
    "expectation_type",
    "column_name",
    "kwargs",
    "element_count",
    "failed_rows",
    "observed_value",
    "success",
)


class QualityGateError(RuntimeError):
    """At least one table failed its checks."""


def not_null(column: str) -> dict:
    return {"expectation_type": NOT_NULL, "kwargs": {"column": column}}


def unique(column: str) -> dict:
    return {"expectation_type": UNIQUE, "kwargs": {"column": column}}


def accepted_values(column: str, values: Sequence) -> dict:
    return {"expectation_type": IN_SET, "kwargs": {"column": column, "value_set": list(values)}}


def relationship(column: str, to: str, field: str) -> dict:
    kwargs = {"column": column, "to": to, "field": field}
    return {"expectation_type": RELATIONSHIP, "kwargs": kwargs}


def run_checks(
    df: DataFrame,
    table_name: str,
    checks: Sequence[dict],
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per check with its failed rows, observed value and verdict."""
    parts, row_checks = [], []
    for number, check in enumerate(checks, start=1):
        kind = check["expectation_type"]
        if kind == UNIQUE or (kind == UNIQUE_SHARE and not check["kwargs"].get("approximate")):
            parts.append(_by_value(df, table_name, number, check))
        elif kind == RELATIONSHIP:
            parent = (parents or {})[check["kwargs"]["to"]]
            parts.append(_orphans(df, parent, table_name, number, check))
        else:
            row_checks.append((number, check))
    if row_checks:
        parts.insert(0, _row_checks(df, table_name, row_checks))
    return reduce(DataFrame.unionByName, parts)


def _row_checks(df: DataFrame, table_name: str, checks: Sequence[tuple[int, dict]]) -> DataFrame:
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count(F.when(violated(check), 1)).alias(f"failed_{number}")
            for number, check in checks
            if check["expectation_type"] not in (ROW_COUNT, UNIQUE_SHARE)
        ],
        *[
            _sketched_share(F.col(check["kwargs"]["column"])).alias(f"share_{number}")
            for number, check in checks
            if check["expectation_type"] == UNIQUE_SHARE
        ],
    )
    rows = F.col("rows")
    results = []
    for number, check in checks:
        if check["expectation_type"] == ROW_COUNT:
            ok = _inside(rows, check["kwargs"])
            results.append(_result(table_name, number, check, rows, None, rows, ok))
        elif check["expectation_type"] == UNIQUE_SHARE:
            share = F.col(f"share_{number}")
            ok = F.coalesce(_inside(share, check["kwargs"]), F.lit(True))
            results.append(_result(table_name, number, check, rows, None, share, ok))
        else:
            failed = F.col(f"failed_{number}")
            results.append(_result(table_name, number, check, rows, failed, None, failed == 0))
    return counted.select(F.inline(F.array(*results)))


def _sketched_share(value: Column) -> Column:
    """Distinct values as a share of the known ones, at most 1; null where none is known."""
    share = F.try_divide(distinct_count(value, approximate=True).cast("double"), F.count(value))
    return F.when(share > 1, 1.0).otherwise(share)


def violated(check: dict) -> Column:
    """Whether a row breaks a check that looks at single rows."""
    kind, kwargs = check["expectation_type"], check["kwargs"]
    value = F.col(kwargs["column"])
    if kind == NOT_NULL:
        return value.isNull()
    if kind == IN_SET:
        return value.isNotNull() & ~value.isin(*kwargs["value_set"])
    if kind == BETWEEN:
        return value.isNotNull() & ~_inside(value, kwargs)
    raise ValueError(f"unknown check: {kind}")


def _inside(value: Column, kwargs: Mapping) -> Column:
    low, high = kwargs.get("min_value"), kwargs.get("max_value")
    tests = [F.lit(True)]
    if low is not None:
        tests.append(value > low if kwargs.get("strict_min") else value >= low)
    if high is not None:
        tests.append(value < high if kwargs.get("strict_max") else value <= high)
    return reduce(lambda a, b: a & b, tests)


def _by_value(df: DataFrame, table_name: str, number: int, check: dict) -> DataFrame:
    column = check["kwargs"]["column"]
    per_value = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    counted = per_value.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("known_rows"),
        F.count("value").alias("distinct_values"),
        F.coalesce(F.sum(F.when(known & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("repeated"),
    )
    rows, repeated = F.col("rows"), F.col("repeated")
    if check["expectation_type"] == UNIQUE:
        result = _result(table_name, number, check, rows, repeated, None, repeated == 0)
    else:
        share = F.try_divide(F.col("distinct_values").cast("double"), F.col("known_rows"))
        ok = F.coalesce(_inside(share, check["kwargs"]), F.lit(True))
        result = _result(table_name, number, check, rows, None, share, ok)
    return counted.select(F.inline(F.array(result)))


def _orphans(
    df: DataFrame, parent: DataFrame, table_name: str, number: int, check: dict
) -> DataFrame:
    kwargs = check["kwargs"]
    per_value = df.groupBy(F.col(kwargs["column"]).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = parent.select(F.col(kwargs["field"]).alias("value"), F.lit(True).alias("found"))
    # A parent that repeats a value must not repeat the child's count.
    known = known.distinct()
    lost = F.col("value").isNotNull() & F.col("found").isNull()
    counted = per_value.join(known, "value", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("orphans"),
    )
    failed = F.col("orphans")
    result = _result(table_name, number, check, F.col("rows"), failed, None, failed == 0)
    return counted.select(F.inline(F.array(result)))


def _result(table_name, number, check, rows, failed, observed, success) -> Column:
    kwargs = check["kwargs"]
    failed = F.lit(None) if failed is None else failed
    observed = F.lit(None) if observed is None else observed
    return F.struct(
        F.lit(table_name).alias("table_name"),
        F.lit(number).alias("check_no"),
        F.lit(check["expectation_type"]).alias("expectation_type"),
        F.lit(kwargs.get("column")).cast("string").alias("column_name"),
        F.lit(json.dumps(kwargs)).alias("kwargs"),
        rows.cast("bigint").alias("element_count"),
        failed.cast("bigint").alias("failed_rows"),
        observed.cast("double").alias("observed_value"),
        success.alias("success"),
    )


def check_freshness(
    df: DataFrame,
    table_name: str,
    loaded_at: str,
    now: dt.datetime,
    warn_after_days: int,
    error_after_days: int,
) -> DataFrame:
    """Age of the newest row against two limits; ``now`` is an argument."""
    newest = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), at(now))
    day = 24 * 60 * 60
    status = (
        F.when(age.isNull() | (age > error_after_days * day), "error")
        .when(age > warn_after_days * day, "warn")
        .otherwise("pass")
    )
    return newest.select(
        F.lit(table_name).alias("table_name"),
        "max_loaded_at",
        age.alias("age_seconds"),
        status.alias("status"),
    )


def failures(results: DataFrame, run_time: dt.datetime) -> DataFrame:
    """The failed checks, each with the number of failures of its table."""
    failed = results.where(~F.col("success"))
    # Results hold one row per check, so the window is a handful of rows.
    total = F.count(F.lit(1)).over(Window.partitionBy("table_name"))
    return failed.select(
        "table_name",
        at(run_time).alias("run_time"),
        total.alias("total_failed"),
        "expectation_type",
        "kwargs",
        F.coalesce(F.col("observed_value").cast("string"), F.lit("N/A")).alias("observed_value"),
        "failed_rows",
    )


def append_failures(failed: DataFrame, path: str) -> None:
    """Add to the audit table; earlier runs stay."""
    failed.write.mode("append").partitionBy("table_name").parquet(path)


def require_passed(results: DataFrame) -> None:
    """Stop before a load when a check failed. Reads one row per failed check."""
    failed = results.where(~F.col("success")).select("table_name", "expectation_type", "kwargs")
    rows = failed.collect()
    if rows:
        listed = "; ".join(f"{r.table_name}: {r.expectation_type} {r.kwargs}" for r in rows)
        raise QualityGateError(f"{len(rows)} failed checks: {listed}")
