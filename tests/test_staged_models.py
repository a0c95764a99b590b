"""Marts of tables staged once: the same rows as from the tables themselves, which are read once."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mercatura.plans import suites, testing
from mercatura.plans.models import Models, StagedModels
from mercatura.session import FREE_SHUFFLES
from mercatura.sources.marketplace import RawTables
from oracles import quality_sql  # noqa: F401
from oracles.entries import REGISTRY

MONEY = "cast({0} as decimal(10,2)) as {0}"


@pytest.fixture(scope="module")
def raw(spark):
    """Ids that repeat, are null or have no partner, in every table; states that change between copies."""
    rng = random.Random(5)
    day = dt.datetime(2018, 1, 1)
    one = lambda *values: rng.choice(values)
    ids = [*range(60), *range(15), None, None]
    orders = [
        (i, one(i, i, 3, None), one("delivered", "delivered", "canceled", "shipped", None),
         one(day + dt.timedelta(rng.randrange(200)), None), one(day + dt.timedelta(rng.randrange(200, 230)), None))
        for i in ids
    ]
    people = [(i, rng.randrange(20), one("1", "2"), "c", one("A", "B", None)) for i in [*range(50), 3, 3, 7, None]]
    items = [
        (one(*ids, 99), n, one(0, 1, 2, 77, None), one(0, 1, 2, 88, None), day, one(5.0, 0.0, 7.5, None), one(1.0, None))
        for n in range(300)
    ]
    payments = [(one(*ids), n, one("card", "slip", None), one(1, 2, 8, 20, None), one(9.5, 0.0, None)) for n in range(120)]
    reviews = [(n, one(*ids), rng.randrange(1, 6), "", "", one(day, day + dt.timedelta(n)), day) for n in range(70)]
    table = spark.createDataFrame
    orders = table(orders, "order_id int, customer_id int, order_status string, a timestamp_ntz, b timestamp_ntz")
    sizes = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    return RawTables(
        orders=orders.select(
            "order_id", "customer_id", "order_status", F.col("a").alias("order_purchase_timestamp"),
            F.col("a").alias("order_approved_at"), F.col("a").alias("order_delivered_carrier_date"),
            F.col("b").alias("order_delivered_customer_date"),
            (F.col("a") + F.expr("interval 215 days")).alias("order_estimated_delivery_date"),
        ),
        customers=table(
            people, "customer_id int, customer_unique_id int, customer_zip_code_prefix string, customer_city string, "
            "customer_state string"),
        order_items=table(
            items, "order_id int, order_item_id int, product_id int, seller_id int, shipping_limit_date timestamp_ntz, "
            "price double, freight_value double",
        ).selectExpr("* except (price, freight_value)", MONEY.format("price"), MONEY.format("freight_value")),
        payments=table(
            payments, "order_id int, payment_sequential int, payment_type string, payment_installments int, "
            "payment_value double",
        ).selectExpr("* except (payment_value)", MONEY.format("payment_value")),
        reviews=table(
            reviews, "review_id int, order_id int, review_score int, review_comment_title string, "
            "review_comment_message string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"),
        products=spark.range(4).selectExpr(
            "cast(id as int) as product_id", "if(id < 2, 'toys', 'other') as product_category_name",
            "1 as product_name_lenght", "1 as product_description_lenght", "1 as product_photos_qty",
            *[f"cast(nullif(id, 1) as decimal(10,2)) as {c}" for c in sizes]),
        sellers=spark.range(4).selectExpr(
            "cast(id as int) as seller_id", "'1' as seller_zip_code_prefix", "'c' as seller_city",
            "nullif(char(65 + id), 'C') as seller_state"),
        geolocation=None,
        category_translation=spark.range(1).selectExpr(
            "'toys' as product_category_name", "'Toys' as product_category_name_english"),
    )


@pytest.mark.parametrize("mart", suites.MART_TESTS)
def test_marts_of_staged_tables_are_those_of_the_tables(raw, mart):
    direct = getattr(Models(raw), mart)
    staged = getattr(StagedModels(Models(raw)), mart)
    assert staged.dtypes == direct.dtypes
    expected = Counter(map(repr, direct.collect()))
    assert len(expected) >= 2
    assert Counter(map(repr, staged.collect())) == expected


def test_mart_tests_read_raw_tables_once_and_free_shuffles(spark, raw, monkeypatch):
    """Each mart read, joined and shuffled orders, items, payments and reviews anew, and all shuffle
    files stayed until the last mart was done."""
    plans, freed, stage = [], [], testing.stage

    def watched(df, label, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        freed.append(spark.conf.get(FREE_SHUFFLES))
        return stage(df, label, *rest)

    monkeypatch.setattr(testing, "stage", watched)
    monkeypatch.setattr("oracles.entries.Marketplace", lambda spark, folder: raw)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    results = REGISTRY["dq_mart_tests"].run(spark, "")
    assert results.count() == sum(map(len, suites.MART_TESTS.values()))
    assert len(plans) == len(suites.MART_TESTS)
    assert not [plan for plan in plans if "ExistingRDD" in plan]
    assert set(freed) == {"true"}
    assert spark.conf.get(FREE_SHUFFLES, "false") == before
