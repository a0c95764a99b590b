"""Orders per group of the marts, where the orders table has copies and rows without an id."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mercatura.plans import marts

DAY = dt.datetime(2018, 1, 1)


@pytest.fixture
def world(spark):
    # Order 1 is there three times, once canceled; 3 has no payment; 4 has types that are not known.
    orders = spark.createDataFrame(
        [(1, "delivered"), (1, "delivered"), (1, "canceled"), (2, "delivered"), (3, "delivered"), (4, "canceled"),
         (None, "delivered")],
        "order_id int, order_status string",
    ).withColumns({c: F.lit(DAY).cast("timestamp_ntz") for c in (
        "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")})
    payments = spark.createDataFrame(
        [(1, "card", 2, 1.0), (1, "card", 5, 2.0), (1, "slip", None, 3.0), (2, "slip", 1, 4.0), (4, None, 1, 5.0),
         (4, None, None, 5.0), (None, "card", 1, 6.0), (9, "card", 1, 7.0)],
        "order_id int, payment_type string, payment_installments int, payment_value double",
    ).withColumn("payment_value", F.col("payment_value").cast("decimal(10,2)"))
    reviews = spark.createDataFrame(
        [(1, 1, 5, DAY)], "order_id int, review_id int, review_score int, review_creation_date timestamp_ntz"
    )
    return orders, payments, reviews


def test_payment_groups_count_an_order_once(world):
    found = {
        (r.dimension_type, r.dimension_value): (r.order_count, float(r.avg_order_value), float(r.total_revenue))
        for r in marts.mart_payment_behavior(*world).collect()
    }
    assert found == {
        ("installment_bucket", "4-6"): (1, 6.0, 54.0),
        ("installment_bucket", "1 (cash/single)"): (2, 8.0, 24.0),
        ("payment_type", "card"): (1, 6.0, 36.0),
        ("payment_type", "slip"): (2, 5.5, 22.0),
    }
    once = marts.mart_payment_behavior(*world, once_per_order=True).where("dimension_value = 'card'").first()
    assert (once.order_count, float(once.total_revenue), float(once.cancellation_rate_pct)) == (1, 18.0, 33.3)


def test_category_and_seller_groups_count_an_order_once(spark, world):
    orders, payments, reviews = world
    items = spark.createDataFrame(
        [(1, 1, 1), (1, 1, 1), (1, 2, 2), (2, 1, 1), (4, 1, 1), (None, 1, 1)], "order_id int, product_id int, seller_id int"
    ).selectExpr("*", "cast(1 as decimal(10,2)) as price", "cast(1 as decimal(10,2)) as freight_value")
    products = spark.range(1, 3).selectExpr("id as product_id", "'toys' as category_name_en", "1 as weight_g")
    toys = marts.mart_category_performance(orders, items, products, reviews).first()
    assert (toys.order_count, toys.item_count) == (2, 7)
    sellers = spark.range(1, 3).selectExpr("id as seller_id", "'A' as seller_state", "'a' as seller_city")
    sold = marts.mart_seller_performance(orders, items, sellers, payments, reviews).collect()
    assert {r.seller_id: r.order_count for r in sold} == {1: 2, 2: 1}


@pytest.mark.parametrize("mart", ["payment", "category"])
def test_no_group_holds_its_orders(spark, world, mart):
    """A distinct count would aggregate by group and order, in memory that grows with the orders of a task."""
    orders, payments, reviews = world
    if mart == "payment":
        made = marts.mart_payment_behavior(orders, payments, reviews)
    else:
        items = spark.range(1).selectExpr("id as order_id", "id as product_id", "1.00 as price", "1.00 as freight_value")
        products = spark.range(1).selectExpr("id as product_id", "'toys' as category_name_en", "1 as weight_g")
        made = marts.mart_category_performance(orders, items, products, reviews)
    plan = made._jdf.queryExecution().toString()
    assert "distinct" not in plan.split("== Physical Plan ==")[0]
    assert "collect_list" not in plan


def test_a_refresh_finds_the_latest_lines_once(spark, monkeypatch):
    from mercatura.plans.models import Models
    from mercatura.sources.marketplace import Marketplace
    from oracles import loads_sql

    read = []
    keep = lambda f: lambda *given: read.extend(given) or f(*given)
    monkeypatch.setattr(loads_sql.marts, "touched_categories", keep(marts.touched_categories))
    loads_sql.refreshed_category(Models(Marketplace(spark, "/root/testdata/sf0.001")))
    plan = read[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "product_id" in read[1].columns and "l_orderkey" not in plan
