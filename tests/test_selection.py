"""Shares by selection against ntile, with intervals that need several rounds."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercatura.operators import selection
from mercatura.operators.selection import Shares, with_shares


@pytest.fixture
def many_rounds(monkeypatch):
    """Intervals shrink a little per round and are read only when they are very small."""
    monkeypatch.setattr(selection, "SAMPLED", 60)
    monkeypatch.setattr(selection, "FETCHED", 20)


def by_window(df, column, count):
    window = Window.orderBy(F.col(column).asc_nulls_last(), F.col("id"))
    return {r.id: r.t for r in df.select("id", F.ntile(count).over(window).alias("t")).collect()}


def by_selection(df, column, count):
    found = with_shares(df, "id", {"t": Shares(column, count)})
    assert found.columns == [*df.columns, "t"]
    return {r.id: r.t for r in found.collect()}


@pytest.mark.parametrize("rows", [0, 1, 4, 5, 11, 503])
def test_shares_equal_ntile_with_ties_and_nulls(spark, many_rounds, rows):
    # Nearly all values are equal and some are null, as with orders per customer.
    value = F.when(F.col("id") % 50 == 7, F.lit(None)).when(F.col("id") % 25 == 3, F.col("id"))
    df = spark.range(rows).select("id", value.otherwise(F.lit(1)).alias("x"))
    assert by_selection(df, "x", 5) == by_window(df, "x", 5)


@pytest.mark.parametrize("kind", ["decimal(20,2)", "double", "string", "timestamp"])
def test_types_of_values(spark, many_rounds, kind):
    number = F.xxhash64("id") % 1000
    value = F.when(F.col("id") % 40 == 0, F.lit(None)).otherwise(number.cast(kind))
    if kind == "double":
        value = F.when(F.col("id") % 41 == 0, F.lit(float("nan"))).otherwise(value / 7)
    df = spark.range(300).select(F.md5(F.col("id").cast("string")).alias("id"), value.alias("x"))
    assert by_selection(df, "x", 4) == by_window(df, "x", 4)


def test_only_nulls_and_the_id_itself(spark, many_rounds):
    df = spark.range(300).select("id", F.lit(None).cast("int").alias("x"))
    assert by_selection(df, "x", 4) == by_window(df, "x", 4)
    assert by_selection(df, "id", 7) == by_window(df, "id", 7)


def test_samples_that_miss_cost_rounds_only(spark, many_rounds, monkeypatch):
    """The two keys are the least and the one after it, whatever the place."""
    monkeypatch.setattr(selection, "_around", lambda keys, share: (keys[0], keys[min(1, len(keys) - 1)]))
    df = spark.range(40).select("id", (F.col("id") * 7 % 13).alias("x"))
    assert by_selection(df, "x", 4) == by_window(df, "x", 4)


def test_a_million_rows_with_a_hot_value(spark):
    value = F.when(F.col("id") % 3 == 0, 5).otherwise(F.xxhash64("id") % 1000)
    df = spark.range(1_000_000).select("id", value.alias("x"))
    found = with_shares(df, "id", {"t": Shares("x", 5)})
    ends = found.groupBy("t").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("x", "id")).alias("low"), F.max(F.struct("x", "id")).alias("high")
    )
    ends = ends.orderBy("t").collect()
    assert [r.n for r in ends] == [200_000] * 5
    assert all(a.high < b.low for a, b in zip(ends, ends[1:]))


def test_repeated_ids_end(spark, many_rounds):
    """They are not allowed, but they must not go on for ever."""
    df = spark.range(100).select((F.col("id") % 2).alias("id"), F.lit(1).alias("x"))
    assert {r.t for r in with_shares(df, "id", {"t": Shares("x", 4)}).collect()} <= {1, 2, 3, 4}


def test_rows_are_neither_sorted_nor_shuffled(spark):
    df = spark.range(5000).select("id", (F.col("id") * 7 % 13).alias("a"), F.md5(F.lit("w")).alias("wide"))
    found = with_shares(df, "id", {"ta": Shares("a", 5), "tb": Shares("id", 4)})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
    assert found.columns == ["id", "a", "wide", "ta", "tb"]


def test_places():
    assert selection.first_places(10, 4) == [3, 6, 8]
    assert selection.first_places(2, 4) == [1]
    assert selection.first_places(0, 4) == []
