"""Distinct counts: exact, or from sketches that are stored once and united at will.

A sketch (HyperLogLog of 2^``lg_k`` registers) is some kilobytes however many values it has seen, so a
distinct count becomes an aggregate like a sum: combined on the map side, stored per partition, and
united over any set of partitions without reading the values again. Up to ``EXACT_BELOW`` values
a sketch keeps the hashes themselves and its count is off only where two of them collide; beyond,
the standard error is ``relative_error(lg_k)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14
EXACT_BELOW = 1_000


def relative_error(lg_k: int = LG_K) -> float:
    """Standard error of an estimate as a share of it; united sketches included."""
    return 1.04 / 2 ** (lg_k / 2)


def distinct_count(value: Column, approximate: bool = False, lg_k: int = LG_K) -> Column:
    """Aggregate: the number of different values, nulls aside."""
    if not approximate:
        return F.count_distinct(value)
    return F.coalesce(F.hll_sketch_estimate(sketch(value, lg_k)), F.lit(0).cast("bigint"))


def sketch(value: Column, lg_k: int = LG_K) -> Column:
    """Aggregate: the sketch of the values, as bytes that can be stored."""
    return F.hll_sketch_agg(value.cast("string"), lg_k)


def sketch_per(df: DataFrame, keys: Sequence[str], value: Column, lg_k: int = LG_K) -> DataFrame:
    """One row per group of ``keys``: its rows and the sketch of ``value``."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"), sketch(value, lg_k).alias("sketch")
    )


def united(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches and row counts of finer groups as those of the coarser ``keys``."""
    return sketches.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"), F.hll_union_agg("sketch").alias("sketch")
    )


def counted(sketches: DataFrame) -> DataFrame:
    """The rows of ``sketches`` with the estimate, ``distinct_count``, in place of the sketch."""
    estimate = F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0).cast("bigint"))
    return sketches.withColumn("distinct_count", estimate).drop("sketch")
