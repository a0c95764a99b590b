"""Staging: one function per raw table, renamed, typed and keyed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.functions.keys import surrogate_key
from mercatura.operators.dedupe import first_per_key

ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "customer_id",
        surrogate_key("order_id").alias("order_key"),
        "order_status",
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in ORDER_TIMES],
    )


def stg_customers(customers: DataFrame) -> DataFrame:
    """``customer_id`` belongs to one order; the person is ``customer_unique_id``."""
    return customers.select(
        "customer_id",
        "customer_unique_id",
        surrogate_key("customer_unique_id").alias("customer_key"),
        F.col("customer_zip_code_prefix").cast("string").alias("zip_code_prefix"),
        "customer_city",
        "customer_state",
    )


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        surrogate_key("seller_id").alias("seller_key"),
        F.col("seller_zip_code_prefix").cast("string").alias("zip_code_prefix"),
        "seller_city",
        "seller_state",
    )


def stg_products(products: DataFrame, category_translation: DataFrame) -> DataFrame:
    """Products with their English category; 'unknown' where there is none."""
    sizes = {
        "product_weight_g": "weight_g",
        "product_length_cm": "length_cm",
        "product_height_cm": "height_cm",
        "product_width_cm": "width_cm",
    }
    return products.join(category_translation, "product_category_name", "left").select(
        "product_id",
        surrogate_key("product_id").alias("product_key"),
        F.col("product_category_name").alias("category_name_pt"),
        F.coalesce("product_category_name_english", F.lit("unknown")).alias("category_name_en"),
        F.col("product_name_lenght").alias("name_length"),
        F.col("product_description_lenght").alias("description_length"),
        F.col("product_photos_qty").alias("photos_qty"),
        *[F.col(raw).cast("decimal(10,2)").alias(name) for raw, name in sizes.items()],
    )


def stg_geolocation(geolocation: DataFrame) -> DataFrame:
    """One centroid per zip; combined on the map side, so a busy zip is cheap."""

    def centroid(column: str):
        return F.round(F.avg(F.col(column).cast("decimal(18,15)")), 15)

    zips = geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        centroid("geolocation_lat").alias("latitude"),
        centroid("geolocation_lng").alias("longitude"),
        F.min("geolocation_city").alias("city"),
        F.min("geolocation_state").alias("state"),
    )
    return zips.select(
        "zip_code_prefix",
        surrogate_key("zip_code_prefix").alias("geolocation_key"),
        "latitude",
        "longitude",
        "city",
        "state",
    )


def stg_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "order_id",
        "payment_sequential",
        surrogate_key("order_id", "payment_sequential").alias("payment_key"),
        "payment_type",
        "payment_installments",
        F.col("payment_value").cast("decimal(10,2)").alias("payment_value"),
    )


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        surrogate_key("order_id", "order_item_id").alias("order_item_key"),
        F.col("shipping_limit_date").cast("timestamp_ntz").alias("shipping_limit_date"),
        F.col("price").cast("decimal(10,2)").alias("price"),
        F.col("freight_value").cast("decimal(10,2)").alias("freight_value"),
    )


def stg_reviews(reviews: DataFrame) -> DataFrame:
    """The latest answer per review and order; unanswered copies come last.

    The remaining columns break ties, so a rerun keeps the same copy. The text
    takes part as a hash: a model that needs no text never shuffles it.
    """
    latest = first_per_key(
        reviews,
        ["review_id", "order_id"],
        [
            F.col("review_answer_timestamp").desc_nulls_last(),
            F.col("review_creation_date").desc_nulls_last(),
            F.col("review_score").desc_nulls_last(),
            F.xxhash64("review_comment_title", "review_comment_message"),
        ],
    )
    return latest.select(
        "review_id",
        "order_id",
        surrogate_key("review_id", "order_id").alias("review_key"),
        "review_score",
        F.col("review_comment_title").alias("comment_title"),
        F.col("review_comment_message").alias("comment_message"),
        F.col("review_creation_date").cast("timestamp_ntz").alias("review_creation_date"),
        F.col("review_answer_timestamp").cast("timestamp_ntz").alias("review_answer_timestamp"),
    )
