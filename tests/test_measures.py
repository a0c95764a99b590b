"""Rounding, keys and calendar arithmetic."""

import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from mercatura.functions import calendar, keys, measures


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_halves_round_away_from_zero(spark):
    ratio = lambda n, d, p: _one(spark, measures.rounded_ratio(F.lit(n), F.lit(d), p))
    assert ratio(201, 200, 2) == Decimal("1.01")
    assert ratio(-201, 200, 2) == Decimal("-1.01")
    assert ratio(5, 2, 0) == 3
    assert ratio(1, 3, 1) == Decimal("0.3")
    assert ratio(1, 0, 1) is None


def test_mean_ignores_nulls_and_weights_apply(spark):
    df = spark.createDataFrame([(5, 2), (None, 10), (1, 1)], "score int, n int")
    row = df.agg(
        measures.mean(F.col("score"), 2).alias("m"),
        measures.weighted_mean(F.col("score"), F.col("n"), 2).alias("w"),
        measures.percentage(F.col("score") == 5, 1, F.col("n")).alias("p"),
    ).first()
    assert (row.m, row.w, row.p) == (3, Decimal("3.67"), Decimal("15.4"))


def test_money_sum_is_exact_and_null_for_no_rows(spark):
    df = spark.createDataFrame([(Decimal("0.10"),)] * 10 + [(None,)], "v decimal(10,2)")
    assert df.agg(measures.money_sum(F.col("v")).alias("s")).first().s == Decimal("1.00")
    assert df.where("v > 5").agg(measures.money_sum(F.col("v")).alias("s")).first().s is None


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    found = [r.k for r in df.select(keys.surrogate_key("x", "y").alias("k")).collect()]
    texts = ("a-b", "a-_dbt_utils_surrogate_key_null_")
    assert found == [hashlib.md5(text.encode()).hexdigest() for text in texts]


def test_days_and_months_count_boundaries(spark):
    at = lambda *a: F.lit(dt.datetime(*a)).cast("timestamp_ntz")
    late, early = at(2020, 1, 31, 23), at(2020, 2, 1, 1)
    assert _one(spark, calendar.days_between(late, early)) == 1
    assert _one(spark, calendar.days_between(early, late)) == -1
    assert _one(spark, calendar.months_between(late, early)) == 1
    assert _one(spark, calendar.month_start(late)) == dt.datetime(2020, 1, 1)
    assert _one(spark, calendar.month_label(late)) == "2020-01"


def test_unreadable_timestamps_become_null(spark):
    parse = lambda text: _one(spark, calendar.parse_timestamp(F.lit(text)))
    assert parse("2018-03-04 05:06:07") == dt.datetime(2018, 3, 4, 5, 6, 7)
    assert parse("2018-03-04") == dt.datetime(2018, 3, 4)
    assert parse("soon") is None
