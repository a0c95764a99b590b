"""The star schema: dimensions, three facts at their own grain, and a daily series.

Customers and sellers have a row per version, and a key per row: a hash of the business key and
the moment the version opened. A fact takes the key of the version that was valid when the order
was placed, found by one sort of facts and versions together, so a fact joins one row of
each dimension. Products and days have no versions; their keys are hashes or dates that a fact
computes itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.functions.calendar import days_between
from mercatura.functions.keys import surrogate_key
from mercatura.operators.history import VALID_FROM, VALID_TO, as_of_join, with_current_flag

# The calendar's default range.
FIRST_DAY, LAST_DAY = dt.date(2016, 1, 1), dt.date(2019, 12, 31)


def date_key(day):
    return F.date_format(day, "yyyyMMdd")


def _calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between the one row's ``first`` and ``last``."""
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("full_date"))
    day = F.col("full_date")
    weekday = F.dayofweek(day)  # 1 is Sunday
    return days.select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.alias("day_of_week"),
        weekday.isin(1, 7).alias("is_weekend"),
        (~weekday.isin(1, 7)).alias("is_weekday"),
    )


def dim_date(spark, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY) -> DataFrame:
    """A complete calendar: days without orders are rows too."""
    return _calendar(
        spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    )


def dim_date_spanning(facts: DataFrame, ts: str) -> DataFrame:
    """The calendar from the first to the last day seen in ``facts``."""
    day = F.to_date(ts)
    return _calendar(facts.agg(F.min(day).alias("first"), F.max(day).alias("last")))


def dim_customers(history: DataFrame) -> DataFrame:
    """All versions of every customer, each with its key; ``history`` comes from snapshots."""
    return with_current_flag(history).select(
        surrogate_key("customer_id", VALID_FROM).alias("customer_key"),
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        F.col("zip_code_prefix").alias("customer_zip_code_prefix"),
        "dbt_valid_from",
        "dbt_valid_to",
        "is_current",
    )


def dim_sellers(history: DataFrame) -> DataFrame:
    """All versions of every seller, each with its key."""
    return with_current_flag(history).select(
        surrogate_key("seller_id", VALID_FROM).alias("seller_key"),
        "seller_id",
        "seller_city",
        "seller_state",
        F.col("zip_code_prefix").alias("seller_zip_code_prefix"),
        "dbt_valid_from",
        "dbt_valid_to",
        "is_current",
    )


def dim_products(products: DataFrame) -> DataFrame:
    """Overwritten on change: products keep no history."""
    return products.select(
        "product_key",
        "product_id",
        F.col("category_name_pt").alias("product_category_name"),
        F.col("category_name_en").alias("product_category_name_english"),
        F.col("weight_g").alias("product_weight_g"),
        F.col("photos_qty").alias("product_photos_qty"),
        F.col("length_cm").alias("product_length_cm"),
        F.col("height_cm").alias("product_height_cm"),
        F.col("width_cm").alias("product_width_cm"),
    )


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    return geolocation.select(
        "zip_code_prefix",
        F.col("latitude").alias("centroid_lat"),
        F.col("longitude").alias("centroid_lng"),
        "city",
        "state",
    )


def _key_or_null(column: str):
    """No key where there is nothing to point at."""
    return F.when(F.col(column).isNotNull(), surrogate_key(column))


def with_version_key(facts: DataFrame, dimension: DataFrame, ident: str, key: str, ts: str) -> DataFrame:
    """``facts`` with the ``key`` of the version of ``ident`` valid at ``ts``.

    What happened before a first snapshot was taken belongs to the first version. The key is
    null only where the dimension has never seen the id, or the fact has no time.
    """
    versions = dimension.select(ident, key, VALID_FROM, VALID_TO)
    return as_of_join(facts, versions, ident, ts, backdate=True).drop(VALID_FROM, VALID_TO)


def _with_version_start(facts: DataFrame, dimension: DataFrame, ident: str, ts: str, name: str) -> DataFrame:
    """``facts`` with the time from which the version of ``ident`` valid at ``ts`` counts, under ``name``.

    With the id it makes the version's key (``_version_key``). Keys are text of a hash, which does not
    compress, so they are made when a fact needs no more shuffles.
    """
    versions = dimension.select(ident, VALID_FROM, VALID_TO)
    return as_of_join(facts, versions, ident, ts, backdate=True).withColumnRenamed(VALID_FROM, name).drop(VALID_TO)


def _version_key(ident: str, start: str):
    """The key that ``dim_customers`` and ``dim_sellers`` give a version; none where there is none."""
    return F.when(F.col(start).isNotNull(), surrogate_key(ident, start))


def fact_order_items(
    order_items: DataFrame, orders: DataFrame, customers: DataFrame, sellers: DataFrame
) -> DataFrame:
    """One row per item with the keys of all dimensions; ``customers`` and ``sellers`` are the
    dimensions with all their versions."""
    placed = "order_purchase_timestamp"
    narrow = orders.select("order_id", "customer_id", placed)
    dated = _with_version_start(narrow, customers, "customer_id", placed, "customer_since")
    items = order_items.select(
        "order_id", "order_item_id", "seller_id", "product_id", "price", "freight_value", "shipping_limit_date"
    ).join(dated.withColumn("is_ordered", F.lit(True)), "order_id", "left")
    return _with_version_start(items, sellers, "seller_id", placed, "seller_since").select(
        "order_id",
        "order_item_id",
        F.when(F.col("is_ordered"), surrogate_key("order_id")).alias("order_key"),
        _version_key("customer_id", "customer_since").alias("customer_key"),
        _version_key("seller_id", "seller_since").alias("seller_key"),
        _key_or_null("product_id").alias("product_key"),
        date_key(F.col(placed)).alias("date_key"),
        "price",
        "freight_value",
        "shipping_limit_date",
    )


def fact_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order; the on-time flag is null until delivery. ``customers`` is the dimension
    with all its versions."""
    placed, arrived = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    since = _with_version_start(
        orders.drop("order_key"), customers, "customer_id", "order_purchase_timestamp", "customer_since"
    )
    return since.select(
        "order_id",
        surrogate_key("order_id").alias("order_key"),
        _version_key("customer_id", "customer_since").alias("customer_key"),
        date_key(placed).alias("date_key"),
        "order_status",
        days_between(placed, arrived).alias("delivery_days"),
        days_between(placed, estimated).alias("estimated_delivery_days"),
        (arrived <= estimated).alias("is_delivered_on_time"),
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )


def fact_payments(payments: DataFrame) -> DataFrame:
    """One row per payment."""
    return payments.select(
        "order_id",
        "payment_sequential",
        surrogate_key("order_id").alias("order_key"),
        "payment_type",
        "payment_installments",
        "payment_value",
    )


def daily_orders(calendar: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders per calendar day, zero on days without any.

    No order drops out: days outside the calendar are rows of their own, and orders without
    a day share one row without a day.
    """
    per_day = orders.groupBy(F.to_date("order_purchase_timestamp").alias("full_date")).agg(
        F.count(F.lit(1)).alias("placed")
    )
    days = calendar.select("date_key", F.col("full_date").alias("day"))
    joined = days.join(per_day, F.col("day") == F.col("full_date"), "full_outer")
    return joined.select(
        F.coalesce("date_key", date_key(F.col("full_date"))).alias("date_key"),
        F.coalesce("day", "full_date").alias("full_date"),
        F.coalesce("placed", F.lit(0)).alias("order_count"),
    )


def join_fan_out(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a left join on ``keys`` would do to the left side's grain, without joining rows.

    Both sides are counted per key first, so the join meets one row per key
    however often a key occurs.
    """
    counted_left = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("left_n"))
    counted_right = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("right_n"))
    matches = F.coalesce("right_n", F.lit(0))
    return counted_left.join(counted_right, list(keys), "left").agg(
        F.coalesce(F.sum("left_n"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col("left_n") * F.greatest(matches, F.lit(1))), F.lit(0)).alias(
            "rows_after"
        ),
        F.count(F.when(matches > 1, 1)).alias("fanned_out_keys"),
    )


def require_same_grain(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    """Raise when joining ``right`` would multiply rows of ``left``."""
    seen = join_fan_out(left, right, keys).first()
    if seen.fanned_out_keys:
        raise ValueError(
            f"a join on {list(keys)} turns {seen.rows_before} rows into {seen.rows_after}: "
            f"{seen.fanned_out_keys} keys match more than once"
        )
