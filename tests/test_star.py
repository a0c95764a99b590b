"""Calendar, daily series, and the fan-out guard."""

import datetime as dt

from pyspark.sql import functions as F

import pytest

from mercatura.operators import history
from mercatura.plans import star


def test_default_calendar(spark):
    days = star.dim_date(spark)
    assert days.count() == 1461
    row = days.where("date_key = '2016-02-29' or date_key = '20160229'").first()
    assert (row.full_date, row.quarter, row.month_name) == (dt.date(2016, 2, 29), 1, "February")
    assert (row.day_name, row.day_of_week, row.is_weekend, row.is_weekday) == (
        "Monday", 2, False, True,
    )
    assert days.where("is_weekend").select("day_name").distinct().count() == 2


def test_days_without_orders_are_zero(spark):
    orders = spark.createDataFrame(
        [(dt.datetime(2018, 1, 1, 5),), (dt.datetime(2018, 1, 1, 9),), (dt.datetime(2018, 1, 3),)],
        "order_purchase_timestamp timestamp_ntz",
    )
    series = star.daily_orders(star.dim_date_spanning(orders, "order_purchase_timestamp"), orders)
    assert [r.order_count for r in series.orderBy("full_date").collect()] == [2, 0, 1]


def test_fan_out_guard(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    row = star.join_fan_out(left, right, ["k"]).first()
    assert tuple(row) == (4, 6, 1) and row.rows_after == left.join(right, "k", "left").count()
    star.require_same_grain(left, right.distinct(), ["k"])
    with pytest.raises(ValueError, match="1 keys match more than once"):
        star.require_same_grain(left, right, ["k"])


def test_orders_outside_the_calendar_stay(spark):
    rows = [("2018-01-01 10:00:00",), ("2018-01-01 11:00:00",), ("2030-05-05 00:00:00",), (None,)]
    orders = spark.createDataFrame(rows, "t string").select(
        F.col("t").cast("timestamp_ntz").alias("order_purchase_timestamp")
    )
    calendar = star.dim_date(spark, dt.date(2018, 1, 1), dt.date(2018, 1, 2))
    found = {r.date_key: r.order_count for r in star.daily_orders(calendar, orders).collect()}
    assert found == {"20180101": 2, "20180102": 0, "20300505": 1, None: 1}


def test_keys_are_unique_per_version_and_facts_take_one(spark):
    day = lambda n: dt.datetime(2018, 1, 1) + dt.timedelta(days=n)
    versions = spark.createDataFrame(
        [(1, "A", day(10), day(20)), (1, "B", day(20), None), (2, "A", day(10), None)],
        "seller_id int, seller_city string, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz",
    ).select("*", F.lit("S").alias("seller_state"), F.lit("1").alias("zip_code_prefix"))
    sellers = star.dim_sellers(versions)
    assert sellers.select("seller_key").distinct().count() == 3
    facts = spark.createDataFrame(
        [(1, 1, day(5)), (2, 1, day(19)), (3, 1, day(20)), (4, 2, day(99)), (5, 3, day(12)), (6, 2, None)],
        "item int, seller_id int, ts timestamp_ntz",
    )
    keyed = star.with_version_key(facts, sellers, "seller_id", "seller_key", "ts")
    star.require_same_grain(keyed, sellers, ["seller_key"])
    joined = keyed.join(sellers.drop("seller_id"), "seller_key", "left")
    assert {r.item: r.seller_city for r in joined.collect()} == {1: "A", 2: "A", 3: "B", 4: "A", 5: None, 6: None}


def test_keys_are_made_after_the_last_shuffle(spark, monkeypatch):
    """No text of a hash is staged with a fact; the keys are those of the dimensions."""
    day = lambda n: dt.datetime(2018, 1, 1) + dt.timedelta(days=n)
    period = "dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz"
    place = [F.lit("1").alias("zip_code_prefix")]
    sellers = star.dim_sellers(
        spark.createDataFrame([(1, "A", day(0), day(9)), (1, "B", day(9), None)], f"seller_id int, seller_city string, {period}")
        .select("*", F.lit("S").alias("seller_state"), *place)
    )
    customers = star.dim_customers(
        spark.createDataFrame([(7, 70, "C", day(5), None)], f"customer_id int, customer_unique_id int, customer_city string, {period}")
        .select("*", F.lit("S").alias("customer_state"), *place)
    )
    orders = spark.createDataFrame(
        [(10, "k10", 7, day(2)), (11, "k11", 8, day(9)), (12, "k12", 7, None)],
        "order_id int, order_key string, customer_id int, order_purchase_timestamp timestamp_ntz",
    )
    items = spark.createDataFrame(
        [(10, 1, 1), (10, 2, None), (11, 1, 1), (12, 1, 1), (99, 1, 1), (None, 1, 1)],
        "order_id int, order_item_id int, seller_id int",
    ).selectExpr("*", "5 as product_id", "1.00 as price", "0.50 as freight_value", "timestamp_ntz '2018-02-01' as shipping_limit_date")
    staged, stage = [], history.stage
    monkeypatch.setattr(history, "stage", lambda df, label: staged.append(df) or stage(df, label))
    facts = star.fact_order_items(items, orders, customers, sellers)
    assert staged and not any("_key" in df.schema.simpleString() for df in staged)
    named = (
        facts.join(sellers.select("seller_key", "seller_city"), "seller_key", "left")
        .join(customers.select("customer_key", "customer_city"), "customer_key", "left")
        .withColumn("known", F.col("order_key") == F.md5(F.col("order_id").cast("string")))
    )
    found = {(r.order_id, r.order_item_id): (r.known, r.seller_city, r.customer_city, r.date_key) for r in named.collect()}
    assert found == {
        (10, 1): (True, "A", "C", "20180103"),
        (10, 2): (True, None, "C", "20180103"),
        (11, 1): (True, "B", None, "20180110"),
        (12, 1): (True, None, None, None),
        (99, 1): (None, None, None, None),
        (None, 1): (None, None, None, None),
    }
