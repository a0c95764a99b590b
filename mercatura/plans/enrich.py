"""Intermediate models and the parts they share with the marts.

A part adds one thing to a set of orders. The marts take only the parts they
need, so for instance corridors never read payments or reviews.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.functions.calendar import days_between, month_start
from mercatura.functions.measures import money_sum
from mercatura.operators.dedupe import first_per_key, mark_first_copy
from mercatura.operators.ranking import sequence_per_key


def delivery_delay_days() -> Column:
    """Days after the estimate; negative is early, null is not delivered."""
    return days_between(
        F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date")
    )


def is_on_time() -> Column:
    """1 when delivered by the estimate, else 0; also 0 while undelivered."""
    in_time = F.col("order_delivered_customer_date") <= F.col("order_estimated_delivery_date")
    return F.when(in_time, 1).otherwise(0)


def with_payment_summary(orders: DataFrame, payments: DataFrame) -> DataFrame:
    summary = payments.groupBy("order_id").agg(
        money_sum(F.col("payment_value")).alias("_paid"),
        F.max("payment_installments").alias("max_installments"),
        F.count(F.lit(1)).alias("payment_count"),
    )
    return (
        orders.join(summary, "order_id", "left")
        .withColumn("total_order_value", F.coalesce("_paid", F.lit(0).cast("decimal(20,2)")))
        .drop("_paid")
    )


def with_latest_review(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    latest = first_per_key(
        reviews.select("order_id", "review_id", "review_score", "review_creation_date"),
        ["order_id"],
        [F.col("review_creation_date").desc_nulls_last(), F.col("review_id").asc_nulls_last()],
    )
    return orders.join(latest.drop("review_id"), "order_id", "left")


def with_customer(orders: DataFrame, customers: DataFrame, *columns: str) -> DataFrame:
    return orders.join(customers.select("customer_id", *columns), "customer_id", "left")


def delivered(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == "delivered")


def with_payment_types(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """The payment summary, and ``payment_types``: the order's payment types with their rows (type_rows), null
    without a payment. An order with very many payments shrinks to its few types on the map side."""
    per_type = payments.groupBy("order_id", "payment_type").agg(
        money_sum(F.col("payment_value")).alias("_paid"),
        F.max("payment_installments").alias("_installments"),
        F.count(F.lit(1)).alias("type_rows"),
    )
    summary = per_type.groupBy("order_id").agg(
        F.sum("_paid").cast("decimal(20,2)").alias("_paid"),
        F.max("_installments").alias("max_installments"),
        F.sum("type_rows").alias("payment_count"),
        F.collect_list(F.struct("payment_type", "type_rows")).alias("payment_types"),
    )
    return (
        orders.join(summary, "order_id", "left")
        .withColumn("total_order_value", F.coalesce("_paid", F.lit(0).cast("decimal(20,2)")))
        .drop("_paid")
    )


def order_facts(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """All that the marts ask about orders, with their payments, latest review and customer.

    A row per row of ``orders`` and row of its customer: ``once`` is true for one row of each row of
    ``orders``, ``first_copy`` for the rows of one copy of each order, a delivered one if there is one.
    """
    asked = orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    delivered_first = [(F.col("order_status") == "delivered").desc_nulls_last()]
    known = mark_first_copy(asked, "order_id", "first_copy", delivered_first)
    known = with_latest_review(with_payment_types(known, payments), reviews)
    # Orders without an id have a customer and a time, but nothing that is joined by the id.
    unknown = asked.where(F.col("order_id").isNull())
    unknown = unknown.withColumn("total_order_value", F.lit(0).cast("decimal(20,2)"))
    every = known.unionByName(unknown, allowMissingColumns=True)
    people = mark_first_copy(
        customers.select("customer_id", "customer_unique_id", "customer_state"), "customer_id", "once"
    )
    return (
        with_customer(every, people, "customer_unique_id", "customer_state", "once")
        .withColumn("once", F.coalesce("once", F.lit(True)))
        .drop("customer_id", "review_creation_date")
    )


def int_orders_enriched(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """One row per order with its payments, latest review and customer state.

    The customer comes first: the joins that follow are all by order, and both
    the payment summary and the latest review already lie by order.
    """
    enriched = with_customer(orders, customers, "customer_state")
    enriched = with_payment_summary(enriched, payments)
    enriched = with_latest_review(enriched, reviews)
    return enriched.select(
        "order_id",
        "order_key",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        delivery_delay_days().alias("delivery_delay_days"),
        is_on_time().alias("is_on_time"),
        "total_order_value",
        "max_installments",
        "payment_count",
        "review_score",
        "review_creation_date",
        "customer_state",
    )


def freight_pct_of_price() -> Column:
    ratio = (F.col("freight_value") * 100) / F.nullif(F.col("price"), F.lit(0))
    return F.when(F.col("price") > 0, F.round(ratio, 2))


def int_order_items_enriched(
    order_items: DataFrame, products: DataFrame, sellers: DataFrame
) -> DataFrame:
    """One row per item with its product, seller and freight share.

    No broadcast is forced: products and sellers grow with the market. Spark
    broadcasts a side when its size allows and otherwise splits skewed
    partitions of the item side at run time.
    """
    about_product = products.select(
        "product_id",
        "category_name_pt",
        F.col("category_name_en").alias("category_name_english"),
        "weight_g",
        "photos_qty",
    )
    about_seller = sellers.select("seller_id", "seller_state", "seller_city")
    return (
        order_items.join(about_product, "product_id", "left")
        .join(about_seller, "seller_id", "left")
        .select(
            "order_id",
            "order_item_id",
            "order_item_key",
            "product_id",
            "seller_id",
            "category_name_pt",
            "category_name_english",
            "weight_g",
            "photos_qty",
            "price",
            "freight_value",
            "shipping_limit_date",
            freight_pct_of_price().alias("freight_pct_of_price"),
            "seller_state",
            "seller_city",
        )
    )


def live_orders(orders: DataFrame) -> DataFrame:
    """Orders that count for a customer's history."""
    return orders.where(~F.col("order_status").isin("canceled", "unavailable"))


def int_customer_enriched(
    orders: DataFrame, customers: DataFrame, order_items: DataFrame
) -> DataFrame:
    """One row per live order with its place in the customer's history."""
    sequenced = sequence_per_key(
        with_customer(live_orders(orders), customers, "customer_unique_id"),
        key="customer_unique_id",
        ts="order_purchase_timestamp",
        id_column="order_id",
        sequence="order_sequence",
        first_ts="first_order_timestamp",
    )
    values = order_items.groupBy("order_id").agg(money_sum(F.col("price")).alias("_value"))
    first = F.col("first_order_timestamp")
    return sequenced.join(values, "order_id", "left").select(
        "order_id",
        "customer_unique_id",
        "order_purchase_timestamp",
        F.coalesce("_value", F.lit(0).cast("decimal(20,2)")).alias("order_value"),
        "order_sequence",
        "first_order_timestamp",
        days_between(first, F.col("order_purchase_timestamp")).alias("days_since_first_order"),
        month_start(first).alias("cohort_month"),
    )


def arrived(orders: DataFrame) -> DataFrame:
    return delivered(orders).where(F.col("order_delivered_customer_date").isNotNull())


def delivered_with_corridor_end(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivered orders that arrived, with the state they went to."""
    known = with_customer(arrived(orders), customers, "customer_state")
    return known.withColumnRenamed("customer_state", "destination_state")


def corridor() -> Column:
    """'origin → destination', null when either end is unknown."""
    return F.concat(F.col("origin_state"), F.lit(" → "), F.col("destination_state"))


def delivery_times() -> list[Column]:
    placed = F.col("order_purchase_timestamp")
    return [
        days_between(placed, F.col("order_delivered_customer_date")).alias("actual_delivery_days"),
        days_between(placed, F.col("order_estimated_delivery_date")).alias(
            "estimated_delivery_days"
        ),
        delivery_delay_days().alias("delay_days"),
        is_on_time().alias("is_on_time"),
    ]


def seller_origins(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", F.col("seller_state").alias("origin_state"))


def int_delivery_analysis(
    orders: DataFrame, order_items: DataFrame, sellers: DataFrame, customers: DataFrame
) -> DataFrame:
    """One row per item of an arrived order with its corridor and timings."""
    ends = delivered_with_corridor_end(orders, customers).select(
        "order_id",
        "destination_state",
        "order_purchase_timestamp",
        "order_estimated_delivery_date",
        "order_delivered_customer_date",
        "order_status",
        *delivery_times(),
    )
    return (
        order_items.join(ends, "order_id")
        .join(seller_origins(sellers), "seller_id", "left")
        .select(
            "order_id",
            "order_item_id",
            "seller_id",
            "origin_state",
            "destination_state",
            corridor().alias("corridor"),
            "price",
            "freight_value",
            "order_purchase_timestamp",
            "order_estimated_delivery_date",
            "order_delivered_customer_date",
            "order_status",
            "actual_delivery_days",
            "estimated_delivery_days",
            "delay_days",
            "is_on_time",
        )
    )
