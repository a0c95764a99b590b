"""Business questions answered from the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.functions.calendar import months_between
from mercatura.functions.measures import mean, percentage, rounded_ratio

# Smallest cohort that is reported.
COHORT_FLOOR = 50

# Installment buckets in logical order.
BUCKET_ORDER = ("1 (cash/single)", "2-3", "4-6", "7-12", "13+")

# The order lifecycle; canceled and unavailable stop at 'created'.
FUNNEL_STAGES = ("created", "approved", "invoiced", "processing", "shipped", "delivered")
DEAD_ENDS = ("canceled", "unavailable")


# ── Sellers ──────────────────────────────────────────────────────────────────


def quadrant() -> Column:
    # Labels and quartile bounds.
    revenue, review = F.col("revenue_quartile"), F.col("review_quartile")
    return (
        F.when((revenue == 4) & (review == 4), "Star Sellers")
        .when((revenue == 4) & (review <= 2), "Revenue Risk")
        .when((revenue <= 2) & (review == 4), "Hidden Gems")
        .otherwise("Middle Pack")
    )


def seller_matrix(sellers: DataFrame) -> DataFrame:
    return (
        sellers.groupBy("revenue_quartile", "review_quartile", quadrant().alias("quadrant_label"))
        .agg(
            F.count(F.lit(1)).alias("seller_count"),
            mean(F.col("on_time_pct"), 1).alias("avg_on_time_pct"),
            mean(F.col("total_revenue"), 0).alias("avg_revenue"),
            mean(F.col("avg_review_score"), 2).alias("avg_review_score"),
            mean(F.col("avg_delay_days"), 1).alias("avg_delay_days"),
        )
        .orderBy(F.col("revenue_quartile").desc(), F.col("review_quartile").desc())
    )


def revenue_risk_sellers(sellers: DataFrame, top: int = 10) -> DataFrame:
    """Top earners in the lower half of the reviews."""
    return (
        sellers.where((F.col("revenue_quartile") == 4) & (F.col("review_quartile") <= 2))
        .orderBy(F.col("total_revenue").desc_nulls_last(), "seller_id")
        .limit(top)
        .select(
            "seller_id",
            "seller_state",
            "total_revenue",
            "avg_review_score",
            "on_time_pct",
            "order_count",
            "review_score_bucket",
        )
    )


# ── Corridors ────────────────────────────────────────────────────────────────


def worst_corridors(corridors: DataFrame, top: int = 15) -> DataFrame:
    return corridors.orderBy("delay_rank").limit(top)


def corridor_volume(corridors: DataFrame) -> DataFrame:
    # Labels and bounds.
    bucket = (
        F.when(F.col("order_count") >= 500, "High volume (500+)")
        .when(F.col("order_count") >= 100, "Mid volume (100-499)")
        .otherwise("Low volume (10-99)")
    )
    return (
        corridors.groupBy(bucket.alias("volume_bucket"))
        .agg(
            F.count(F.lit(1)).alias("corridor_count"),
            mean(F.col("avg_delay_days"), 1).alias("avg_delay_days"),
            mean(F.col("late_pct"), 1).alias("avg_late_pct"),
        )
        .orderBy(F.col("avg_delay_days").desc_nulls_last())
    )


def corridor_delay_buckets(corridors: DataFrame) -> DataFrame:
    # Labels and bounds.
    delay = F.col("avg_delay_days")
    bucket = (
        F.when(delay <= 0, "1. On time or early")
        .when(delay <= 3, "2. 1-3 days late")
        .when(delay <= 7, "3. 4-7 days late")
        .when(delay <= 14, "4. 8-14 days late")
        .otherwise("5. 15+ days late")
    )
    return (
        corridors.groupBy(bucket.alias("delay_bucket"))
        .agg(
            F.count(F.lit(1)).alias("corridor_count"),
            mean(delay, 1).alias("avg_delay_days"),
            mean(F.col("late_pct"), 1).alias("avg_late_pct"),
            F.sum("order_count").alias("total_orders"),
        )
        .orderBy("delay_bucket")
    )


# ── Retention ────────────────────────────────────────────────────────────────


def _retention(**columns: str) -> list[Column]:
    return [percentage(F.col(flag) == 1, 1).alias(name) for name, flag in columns.items()]


def cohort_retention(cohorts: DataFrame, floor: int = COHORT_FLOOR) -> DataFrame:
    """Share of each month's new customers who came back, cohorts of ``floor`` or more only."""
    return (
        cohorts.groupBy("cohort_month")
        .agg(
            F.count(F.lit(1)).alias("cohort_size"),
            *_retention(
                retention_30d_pct="repeat_within_30d",
                retention_60d_pct="repeat_within_60d",
                retention_90d_pct="repeat_within_90d",
                lifetime_repeat_pct="is_repeat_customer",
            ),
        )
        .where(F.col("cohort_size") >= floor)
        .orderBy("cohort_month")
    )


def platform_retention(cohorts: DataFrame) -> DataFrame:
    return cohorts.agg(
        F.count(F.lit(1)).alias("total_customers"),
        *_retention(
            platform_30d_pct="repeat_within_30d",
            platform_60d_pct="repeat_within_60d",
            platform_90d_pct="repeat_within_90d",
            platform_lifetime_repeat_pct="is_repeat_customer",
        ),
    )


# ── Payments ─────────────────────────────────────────────────────────────────


def installment_buckets(payment_behavior: DataFrame) -> DataFrame:
    place = F.array_position(F.array(*[F.lit(b) for b in BUCKET_ORDER]), F.col("dimension_value"))
    return (
        payment_behavior.where(F.col("dimension_type") == "installment_bucket")
        .orderBy(place)
        .select(
            F.col("dimension_value").alias("installment_bucket"),
            "order_count",
            "avg_order_value",
            "total_revenue",
            "avg_review_score",
            "cancellation_rate_pct",
        )
    )


def payment_types(payment_behavior: DataFrame) -> DataFrame:
    return (
        payment_behavior.where(F.col("dimension_type") == "payment_type")
        .orderBy(F.col("avg_order_value").desc_nulls_last(), "dimension_value")
        .select(
            F.col("dimension_value").alias("payment_type"),
            "order_count",
            "avg_order_value",
            "avg_review_score",
            "cancellation_rate_pct",
        )
    )


# ── Review scores ────────────────────────────────────────────────────────────


def lowest_rated_categories(categories: DataFrame, top: int = 15) -> DataFrame:
    return (
        categories.where(F.col("avg_review_score").isNotNull())
        .orderBy("avg_review_score", "category_name_english")
        .limit(top)
        .select(
            "category_name_english",
            "avg_review_score",
            "avg_delay_days",
            "order_count",
            "total_revenue",
        )
    )


def delay_against_low_scores(orders_enriched: DataFrame) -> DataFrame:
    """Share of delivered, reviewed orders scored 1 or 2, by how late they were."""
    # Labels and bounds, as for corridors.
    delay = F.col("delivery_delay_days")
    bucket = (
        F.when(delay <= 0, "1. On time or early")
        .when(delay <= 3, "2. 1-3 days late")
        .when(delay <= 7, "3. 4-7 days late")
        .when(delay <= 14, "4. 8-14 days late")
        .otherwise("5. 15+ days late")
    )
    return (
        orders_enriched.where(delay.isNotNull() & F.col("review_score").isNotNull())
        .groupBy(bucket.alias("delay_bucket"))
        .agg(
            F.count(F.lit(1)).alias("reviewed_orders"),
            percentage(F.col("review_score") <= 2, 1).alias("low_score_pct"),
            mean(F.col("review_score"), 2).alias("avg_review_score"),
        )
        .orderBy("delay_bucket")
    )


# ── Lifetime value ───────────────────────────────────────────────────────────


def clv_by_cohort(
    cohorts: DataFrame, customer_metrics: DataFrame, cohort_floor: int = 0
) -> DataFrame:
    """Running average spend per cohort over tenure months.

    ``cohort_floor`` leaves out cohorts with fewer customers.
    """
    spend = customer_metrics.select("customer_unique_id", "total_spend", "last_order_date").where(
        F.col("total_spend").isNotNull()
    )
    tenure = months_between(F.col("first_order_date"), F.col("last_order_date"))
    summary = (
        cohorts.select("customer_unique_id", "cohort_month", "first_order_date")
        .join(spend, "customer_unique_id")
        .groupBy("cohort_month", tenure.alias("tenure_months"))
        .agg(
            F.count("customer_unique_id").alias("customer_count"),
            mean(F.col("total_spend"), 2).alias("avg_spend_per_customer"),
        )
    )
    # One row per cohort and tenure month from here on.
    if cohort_floor:
        in_cohort = F.sum("customer_count").over(Window.partitionBy("cohort_month"))
        summary = (
            summary.withColumn("_size", in_cohort)
            .where(F.col("_size") >= cohort_floor)
            .drop("_size")
        )
    so_far = (
        Window.partitionBy("cohort_month")
        .orderBy("tenure_months")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return summary.withColumn(
        "cumulative_avg_clv", F.round(F.sum("avg_spend_per_customer").over(so_far), 2)
    ).orderBy("cohort_month", "tenure_months")


# ── Funnel ───────────────────────────────────────────────────────────────────


def order_funnel(orders: DataFrame) -> DataFrame:
    """Distinct orders that reached each stage, against the stage before and the top.

    Every stage contains the later ones, so an order counts for all stages up to
    the furthest it is seen in: one pass and one shuffle by order instead of a
    scan or a distinct count per stage.
    """
    reached = F.when(F.col("order_status").isin(*DEAD_ENDS), 1)
    for place, stage in enumerate(FUNNEL_STAGES, start=1):
        reached = reached.when(F.col("order_status") == stage, place)
    furthest = orders.groupBy("order_id").agg(F.max(reached).alias("reached")).where(
        F.col("order_id").isNotNull()
    )
    counts = furthest.agg(
        *[
            F.count(F.when(F.col("reached") >= place, 1)).alias(stage)
            for place, stage in enumerate(FUNNEL_STAGES, start=1)
        ]
    )
    stages = counts.select(
        F.posexplode(
            F.array(
                *[
                    F.struct(F.lit(s).alias("stage_name"), F.col(s).alias("stage_count"))
                    for s in FUNNEL_STAGES
                ]
            )
        ).alias("place", "stage")
    ).select((F.col("place") + 1).alias("stage_order"), "stage.*")
    # Six rows: the windows below are over the stages, not the orders.
    by_stage = Window.orderBy("stage_order")
    whole = by_stage.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    count, before = F.col("stage_count"), F.col("prev_stage_count")
    return (
        stages.withColumn("prev_stage_count", F.lag("stage_count").over(by_stage))
        .withColumn("_top", F.first("stage_count").over(whole))
        .select(
            "stage_order",
            "stage_name",
            "stage_count",
            "prev_stage_count",
            rounded_ratio((count - before) * 100, before, 1).alias("stage_over_stage_pct"),
            rounded_ratio(count * 100, F.col("_top"), 1).alias("pct_of_top_funnel"),
        )
        .orderBy("stage_order")
    )
