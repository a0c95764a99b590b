"""Averages and shares rounded once, from exact sums.

Averages are taken as sum / count in wide decimals instead of ``avg`` on
doubles, so a result does not depend on the order in which partitions are added
up and half values round the same way on every run.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """numerator / denominator, half away from zero; null over zero."""
    return F.round(
        F.try_divide(numerator.cast("decimal(26,2)"), denominator.cast("decimal(15,0)")), places
    )


def mean(column: Column, places: int) -> Column:
    """Average of the non-null values."""
    return rounded_ratio(F.sum(column), F.count(column), places)


def weighted_mean(column: Column, weight: Column, places: int) -> Column:
    """Average of the non-null values, each counted ``weight`` times."""
    return rounded_ratio(
        weighted_sum(column, weight), F.sum(F.when(column.isNotNull(), weight)), places
    )


def money_sum(column: Column) -> Column:
    """Sum of a decimal with two places, added up in whole cents.

    Sums of longs update in place in the aggregation map, sums of wide decimals
    do not. For sums within one order; a total past 9e16 is an error, not a wrap.
    """
    cents = (column * 100).cast("bigint")
    return (F.sum(cents).cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def weighted_sum(column: Column, weight: Column) -> Column:
    return F.sum(column * weight.cast("decimal(12,0)"))


def percentage(condition: Column, places: int, weight: Column | None = None) -> Column:
    """Share of rows (or of weight) for which the condition holds, in percent."""
    weight = F.lit(1) if weight is None else weight
    held = F.sum(F.when(condition, weight).otherwise(F.lit(0)))
    return rounded_ratio(held * 100, F.sum(weight), places)
