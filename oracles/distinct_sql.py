"""Distinct counts by sketches: stored per month, united, compared with the exact ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.operators import distinct, quality
from mercatura.plans import marts
from mercatura.plans.models import Models
from mercatura.session import stage
from oracles.entries import register

# Three standard errors; a sketch that is exact passes too.
TOLERANCE = 3 * distinct.relative_error()


def near(estimate: Column, exact: Column) -> Column:
    return F.abs(estimate - exact) <= F.lit(TOLERANCE) * exact


def united_sketches(m: Models) -> DataFrame:
    """Customers per year, united from the stored sketches of its months."""
    placed = F.col("order_purchase_timestamp")
    orders = m.stg_orders.join(m.stg_customers.select("customer_id", "customer_unique_id"), "customer_id")
    orders = orders.withColumns({"year": F.year(placed), "month": F.month(placed)})
    months = distinct.sketch_per(orders, ["year", "month"], F.col("customer_unique_id"))
    years = distinct.counted(distinct.united(stage(months, "sketches"), ["year"]))
    exact = orders.groupBy("year").agg(F.count_distinct("customer_unique_id").alias("customers"))
    return years.join(exact, "year").withColumn("is_near", near(F.col("distinct_count"), F.col("customers")))


register(
    "agg_distinct_sketches",
    "year i, row_count i, customers i, is_near b",
    united_sketches,
    """select year(order_purchase_timestamp) as year, count(*) as row_count,
       count(distinct customer_unique_id) as customers, true as is_near
from m_orders join m_customers using (customer_id) group by 1""",
)


def category_orders(m: Models) -> DataFrame:
    given = (m.stg_orders, m.stg_order_items, m.stg_products, m.stg_reviews)
    rough = marts.mart_category_performance(*given, approximate=True)
    exact = marts.mart_category_performance(*given).select(
        "category_name_english", F.col("order_count").alias("exact_count")
    )
    joined = rough.join(exact, "category_name_english")
    return joined.withColumn("is_near", near(F.col("order_count"), F.col("exact_count")))


register(
    "mart_category_approximate",
    "category_name_english s, exact_count i, total_revenue d, is_near b",
    category_orders,
    "select category_name_english, order_count as exact_count, total_revenue, true as is_near from mart_category",
)


def share_check(m: Models) -> DataFrame:
    """The share of distinct reviews, exact and sketched, with bounds both pass and bounds both fail."""
    def check(low: float, approximate: bool) -> dict:
        kwargs = {"column": "review_id", "min_value": low, "max_value": 1.0, "approximate": approximate}
        return {"expectation_type": quality.UNIQUE_SHARE, "kwargs": kwargs}

    checks = [check(low, rough) for rough in (False, True) for low in (0.9, 0.995)]
    results = quality.run_checks(m.raw.reviews, "reviews", checks)
    exact = results.where("check_no = 1").select(F.col("observed_value").alias("exact"), "table_name")
    return results.join(exact, "table_name").withColumn("is_near", near(F.col("observed_value"), F.col("exact")))


register(
    "dq_distinct_share",
    "check_no i, element_count i, exact d, is_near b, success b",
    share_check,
    """select check_no, count(*) as element_count, count(distinct review_id) / count(review_id) as exact,
       true as is_near, count(distinct review_id) / count(review_id) >= low as success
from m_raw_reviews, (values (1, 0.9), (2, 0.995), (3, 0.9), (4, 0.995)) v(check_no, low)
group by check_no, low""",
)
