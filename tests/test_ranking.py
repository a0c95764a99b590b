"""Distributed ranks against Spark's own windows on ties, nulls and hot keys."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercatura.operators.ranking import Tiles, sequence_per_key, with_tiles


def _tiles_by_window(df, column, tiles):
    window = Window.orderBy(F.col(column).asc_nulls_last(), F.col("id"))
    return {r.id: r.t for r in df.select("id", F.ntile(tiles).over(window).alias("t")).collect()}


def _tiles(df, column, tiles):
    ranked = with_tiles(df, "id", {"t": Tiles([F.col(column).asc_nulls_last()], tiles)})
    return {r.id: r.t for r in ranked.collect()}


@pytest.mark.parametrize("rows", [0, 1, 3, 4, 5, 9, 10, 11, 1003])
@pytest.mark.parametrize("tiles", [4, 5])
def test_tiles_equal_ntile(spark, rows, tiles):
    # Nearly all values are equal and some are null, as with orders per customer.
    value = F.when(F.col("id") % 50 == 7, F.lit(None)).when(F.col("id") % 25 == 3, F.col("id"))
    df = spark.range(rows).select("id", value.otherwise(F.lit(1)).alias("x"))
    assert _tiles(df, "x", tiles) == _tiles_by_window(df, "x", tiles)


def test_several_tiles_at_once(spark):
    df = spark.range(200).select(
        "id", (F.col("id") * 7 % 13).alias("a"), (F.col("id") * 11 % 17).alias("b")
    )
    ranked = with_tiles(df, "id", {"ta": Tiles([F.col("a")], 5), "tb": Tiles([F.col("b")], 4)})
    found = {r.id: (r.ta, r.tb) for r in ranked.collect()}
    a, b = _tiles_by_window(df, "a", 5), _tiles_by_window(df, "b", 4)
    assert found == {i: (a[i], b[i]) for i in range(200)}
    assert ranked.columns == ["id", "a", "b", "ta", "tb"]


def test_tile_sizes_differ_by_at_most_one(spark):
    ranked = with_tiles(
        spark.range(1234).withColumn("x", F.lit(1)), "id", {"t": Tiles([F.col("x")], 5)}
    )
    sizes = [r["count"] for r in ranked.groupBy("t").count().collect()]
    assert sum(sizes) == 1234 and max(sizes) - min(sizes) <= 1


def test_sequence_equals_window_with_a_hot_key_and_nulls(spark):
    # Key 0 holds a third of the rows; some keys and times are null.
    start = dt.datetime(2020, 1, 1)
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 11 == 1, None)
    ts = F.when(F.col("id") % 17 != 5, F.lit(start) + F.make_dt_interval(F.col("id") * 7 % 40, F.col("id") * 5 % 24))
    df = spark.range(3000).select(
        "id", key.otherwise(F.col("id") % 50).alias("k"), ts.cast("timestamp_ntz").alias("ts")
    )
    found = {
        (r.id, r.k, r.ts): (r.n, r.first)
        for r in sequence_per_key(df, "k", "ts", "id", "n", "first").collect()
    }
    whole = Window.partitionBy("k")
    expected = {
        (r.id, r.k, r.ts): (r.n, r.first)
        for r in df.select(
            "id",
            "k",
            "ts",
            F.row_number().over(whole.orderBy(F.col("ts").asc_nulls_last(), "id")).alias("n"),
            F.min("ts").over(whole).alias("first"),
        ).collect()
    }
    assert len(found) == 3000 and found == expected


def test_one_key_and_instant_with_a_third_of_the_rows_is_split(spark):
    rows = spark.range(30_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("ts"),
    )
    found = sequence_per_key(rows, "k", "ts", "id", "n", "first")
    hot = found.where("k = 0")
    assert hot.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 10_000, 10_000)
    assert found.where("k <> 0 and n <> 1").isEmpty()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sorted_parts = rows.orderBy("k", "ts", "id").groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in sorted_parts.collect()) < 10_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
