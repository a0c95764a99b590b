"""Models on made-up tables with hot keys, orphans, nulls and zeros.

The expected results come from the same plain SQL as the registered checks, run
by DuckDB over the same rows.
"""

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest

from mercatura.plans.models import Models
from mercatura.sources.marketplace import RawTables
from oracles import models_sql
from oracles.compare import difference
from oracles.duck import query
from oracles.registry import portable

STATUSES = ["delivered"] * 6 + ["shipped", "canceled", "unavailable", "created"]
BASE = ("m_orders", "m_customers", "m_items", "m_payments", "m_reviews", "m_raw_products")
BASE += ("m_sellers",)
START = dt.datetime(2018, 1, 1)


def _rows(rng, n=400):
    """A third of everything sits on one key: order 0, customer 0, seller 0, product 0."""

    def hot(limit):
        return 0 if rng.random() < 1 / 3 else rng.randrange(limit)

    orders, customers, items, payments, reviews = [], [], [], [], []
    for i in range(n):
        placed = START + dt.timedelta(days=rng.randrange(120), hours=rng.randrange(24))
        arrived = placed + dt.timedelta(days=rng.randrange(40)) if rng.random() < 0.8 else None
        orders.append((i, i, rng.choice(STATUSES), placed, None, None, arrived,
                       placed + dt.timedelta(days=25)))
        if i % 29:  # some orders have no customer row
            customers.append((i, hot(60), "1", "town", rng.choice(["A", "B", None])))
    for i in range(3 * n):
        price = Decimal(rng.choice([0, 100, 333, 1999])) / 100
        items.append((hot(n + 5), i, hot(25), hot(12), START + dt.timedelta(days=i % 50), price,
                      Decimal(rng.randrange(500)) / 100))
    for i in range(2 * n):
        payments.append((hot(n), i, rng.choice(["boleto", "voucher", None]),
                         rng.choice([0, 1, 2, 5, 12, 24, None]), Decimal(rng.randrange(9999)) / 100))
    for i in range(n):
        created = START + dt.timedelta(days=rng.randrange(20))
        reviews.append((i, hot(n), rng.choice([1, 2, 3, 4, 5]), "t", "m", created, created))
    products = [(i, rng.choice(["SMALL", "PROMO", None]), 1, 1, 1, Decimal(i), None, None, None)
                for i in range(20)]
    sellers = [(i, "1", "town", rng.choice(["A", "B"])) for i in range(10)]
    return orders, customers, items, payments, reviews, products, sellers


@pytest.fixture(scope="module", params=[1, 2])
def world(request, spark):
    rows = _rows(random.Random(request.param))
    orders, customers, items, payments, reviews, products, sellers = rows
    frame = spark.createDataFrame
    raw = RawTables(
        orders=frame(
            orders,
            "order_id bigint, customer_id bigint, order_status string, "
            "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
            "order_delivered_carrier_date timestamp_ntz, "
            "order_delivered_customer_date timestamp_ntz, "
            "order_estimated_delivery_date timestamp_ntz",
        ),
        customers=frame(
            customers,
            "customer_id bigint, customer_unique_id bigint, customer_zip_code_prefix string, "
            "customer_city string, customer_state string",
        ),
        order_items=frame(
            items,
            "order_id bigint, order_item_id int, product_id bigint, seller_id bigint, "
            "shipping_limit_date timestamp_ntz, price decimal(10,2), freight_value decimal(10,2)",
        ),
        payments=frame(
            payments,
            "order_id bigint, payment_sequential int, payment_type string, "
            "payment_installments int, payment_value decimal(10,2)",
        ),
        reviews=frame(
            reviews,
            "review_id bigint, order_id bigint, review_score int, review_comment_title string, "
            "review_comment_message string, review_creation_date timestamp_ntz, "
            "review_answer_timestamp timestamp_ntz",
        ),
        products=frame(
            products,
            "product_id bigint, product_category_name string, product_name_lenght int, "
            "product_description_lenght int, product_photos_qty int, "
            "product_weight_g decimal(10,2), product_length_cm decimal(10,2), "
            "product_height_cm decimal(10,2), product_width_cm decimal(10,2)",
        ),
        sellers=frame(
            sellers,
            "seller_id bigint, seller_zip_code_prefix string, seller_city string, "
            "seller_state string",
        ),
        geolocation=frame([], "geolocation_zip_code_prefix string"),
        category_translation=frame(
            [("SMALL", "small")],
            "product_category_name string, product_category_name_english string",
        ),
    )
    con = duckdb.connect()

    def table(name, df):
        arrow = pa.Table.from_pydict(
            {c: [r[c] for r in df.collect()] for c in df.columns}, schema=df.toArrow().schema
        )
        con.register("arriving", arrow)
        con.execute(f"create table {name} as select * from arriving")

    table("m_orders", raw.orders)
    table("m_customers", raw.customers.withColumnRenamed("customer_zip_code_prefix", "zip_code_prefix"))
    table("items", raw.order_items)
    table("payments", raw.payments)
    table("m_reviews", raw.reviews)
    table("products", raw.products)
    table("m_sellers", raw.sellers.withColumnRenamed("seller_zip_code_prefix", "zip_code_prefix"))
    con.execute(
        "create table m_items as select *, cast(price * 100 as bigint) as price_c, "
        "cast(freight_value * 100 as bigint) as freight_c from items"
    )
    con.execute("alter table m_items drop price")
    con.execute("alter table m_items drop freight_value")
    con.execute(
        "create table m_payments as select *, cast(payment_value * 100 as bigint) as value_c "
        "from payments"
    )
    con.execute(
        "create table m_raw_products as select product_id, "
        "product_category_name as category_name_pt, product_weight_g as weight_g, "
        "product_photos_qty as photos_qty from products"
    )
    return Models(raw), con


CASES = {
    "int_customer_enriched": (
        "order_id i, customer_unique_id i, order_value d, order_sequence i, "
        "first_order_timestamp t, days_since_first_order i, cohort_month t",
        "select *, value_c / 1e2 as order_value from x_customer",
    ),
    "int_orders_enriched": (
        "order_id i, order_status s, delivery_delay_days i, is_on_time i, "
        "total_order_value d, max_installments i, payment_count i, review_score i, "
        "customer_state s",
        "select *, value_c / 1e2 as total_order_value from x_orders",
    ),
    "int_order_items_enriched": (
        "order_id i, order_item_id i, category_name_english s, price d, "
        "freight_pct_of_price d, seller_state s",
        "select *, price_c / 1e2 as price, share_c / 1e2 as freight_pct_of_price from x_items",
    ),
    "mart_category_performance": (models_sql.CATEGORY, "select * from mart_category"),
    "mart_customer_cohorts": (
        "customer_unique_id i, cohort_month t, first_order_date t, last_order_date t, "
        "total_orders i, customer_tenure_days i, repeat_within_30d i, repeat_within_60d i, "
        "repeat_within_90d i, is_repeat_customer i",
        "select * from mart_cohorts",
    ),
    "mart_delivery_analysis": (models_sql.CORRIDORS, "select * from mart_delivery"),
    "mart_payment_behavior": (models_sql.PAYMENT, "select * from mart_payment"),
    "mart_rfm_segmentation": (
        "customer_unique_id i, total_orders i, total_spend d, avg_review_score d, "
        "days_since_last_order i, r_score i, f_score i, m_score i, segment s",
        "select * from mart_rfm",
    ),
    "mart_seller_performance": (models_sql.SELLER, "select * from mart_seller"),
}


@pytest.mark.parametrize("model", CASES)
def test_model_equals_plain_sql(world, model):
    models, con = world
    columns, body = CASES[model]
    ours = portable(getattr(models, model), columns)
    assert difference(ours, con, query(body, columns, given=BASE)) is None
