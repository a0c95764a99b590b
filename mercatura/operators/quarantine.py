"""Rows that break rules, set apart with the reasons, in one pass over the source.

Every rule of a row is tested, so a row tells all that is wrong with it. Good and bad rows go to one table
of two partitions in a single write, and the reasons are counted while it is written: the source
is read once, nothing is shuffled, and a corrected row can be sent again from what was kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercatura.operators.quality import ROW_COUNT, RELATIONSHIP, UNIQUE, UNIQUE_SHARE, violated

REASONS = "violated_rules"
FOLDER = "quarantined"


def rule_name(check: dict) -> str:
    """Column and kind of a check, as the reason of a row."""
    kind = check["expectation_type"].removeprefix("expect_column_values_to_")
    return f"{check['kwargs']['column']}: {kind}"


def row_rules(checks: Sequence[dict]) -> list[dict]:
    """The checks that a single row can break."""
    return [c for c in checks if c["expectation_type"] not in (ROW_COUNT, UNIQUE, UNIQUE_SHARE, RELATIONSHIP)]


def reasons(checks: Sequence[dict]) -> Column:
    """The rules a row breaks, in the order of ``checks``; empty for a good row."""
    told = [F.when(F.coalesce(violated(c), F.lit(False)), F.lit(rule_name(c))) for c in checks]
    return F.filter(F.array(*told), lambda r: r.isNotNull()) if told else F.array().cast("array<string>")


def with_reasons(df: DataFrame, checks: Sequence[dict]) -> DataFrame:
    """Every row with ``violated_rules``."""
    return df.withColumn(REASONS, reasons(row_rules(checks)))


class Split(NamedTuple):
    """What a split wrote: rows of either side, and rows per reason (a row counts for each of its)."""

    good: int
    bad: int
    per_rule: dict[str, int]


def split(df: DataFrame, checks: Sequence[dict], path: str) -> Split:
    """Write the rows of ``df`` under ``path``, good and bad ones apart; see ``good_rows``, ``bad_rows``."""
    rules = row_rules(checks)
    names = [rule_name(c) for c in rules]
    marked = with_reasons(df, rules).withColumn(FOLDER, F.size(REASONS) > 0)
    seen = Observation()
    counted = marked.observe(
        seen,
        F.count(F.when(~F.col(FOLDER), 1)).alias("good"),
        F.count(F.when(F.col(FOLDER), 1)).alias("bad"),
        *[
            F.count(F.when(F.array_contains(REASONS, name), 1)).alias(f"rule_{i}")
            for i, name in enumerate(names)
        ],
    )
    counted.write.mode("overwrite").partitionBy(FOLDER).parquet(path)
    found = seen.get
    per_rule = {name: found[f"rule_{i}"] for i, name in enumerate(names)}
    return Split(found["good"], found["bad"], per_rule)


def _side(spark: SparkSession, path: str, bad: bool, like: DataFrame) -> DataFrame:
    schema = with_reasons(like, []).schema.add(FOLDER, "boolean")
    return spark.read.schema(schema).parquet(path).where(F.col(FOLDER) == bad).drop(FOLDER)


def good_rows(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows that broke no rule, with the columns of ``like``."""
    return _side(spark, path, False, like).drop(REASONS)


def bad_rows(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows set apart, with ``violated_rules``."""
    return _side(spark, path, True, like)
