"""The frames a dashboard reads and their reshapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.functions.calendar import month_label
from mercatura.plans import analyses

# Retention columns and how their windows are labelled.
RETENTION_WINDOWS = {
    "retention_30d": "30 Days",
    "retention_60d": "60 Days",
    "retention_90d": "90 Days",
}


def seller_frame(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        "seller_state",
        "total_revenue",
        "avg_review_score",
        "on_time_pct",
        "order_count",
        "revenue_quartile",
        "review_quartile",
        "review_score_bucket",
        "avg_delay_days",
    )


def corridor_frame(corridors: DataFrame) -> DataFrame:
    return analyses.worst_corridors(corridors).select(
        "corridor",
        "origin_state",
        "destination_state",
        "order_count",
        "avg_delay_days",
        "late_pct",
        "delay_rank",
    )


def retention_frame(cohorts: DataFrame) -> DataFrame:
    return analyses.cohort_retention(cohorts).select(
        "cohort_month",
        "cohort_size",
        *[F.col(f"{name}_pct").alias(name) for name in RETENTION_WINDOWS],
    )


def installment_frame(payment_behavior: DataFrame) -> DataFrame:
    return analyses.installment_buckets(payment_behavior).select(
        F.col("installment_bucket").alias("dimension_value"),
        "order_count",
        "avg_order_value",
        "cancellation_rate_pct",
        "avg_review_score",
    )


def rfm_frame(rfm: DataFrame) -> DataFrame:
    return rfm.select(
        "customer_unique_id",
        "r_score",
        "f_score",
        "m_score",
        "segment",
        "total_spend",
        "total_orders",
        "days_since_last_order",
    )


def seller_heatmap(sellers: DataFrame) -> DataFrame:
    """Mean on-time share, revenue quartiles down and review quartiles across."""
    share = F.sum("on_time_pct").cast("double") / F.count("on_time_pct")
    return (
        sellers.groupBy("revenue_quartile")
        .pivot("review_quartile", [1, 2, 3, 4])
        .agg(share)
        .orderBy(F.col("revenue_quartile").desc())
    )


def corridors_by_delay(corridors: DataFrame) -> DataFrame:
    return corridors.orderBy(F.col("avg_delay_days").asc_nulls_last(), "corridor")


def label_cohort_month(df: DataFrame, column: str = "cohort_month") -> DataFrame:
    return df.withColumn(column, month_label(F.col(column)))


def retention_long(retention: DataFrame) -> DataFrame:
    """One row per cohort and window; also takes columns that end in ``_pct``."""
    for name in RETENTION_WINDOWS:
        if f"{name}_pct" in retention.columns:
            retention = retention.withColumnRenamed(f"{name}_pct", name)
    ids = [c for c in ("cohort_month", "cohort_size") if c in retention.columns]
    labels = F.create_map(*[F.lit(x) for pair in RETENTION_WINDOWS.items() for x in pair])
    return retention.unpivot(
        ids, list(RETENTION_WINDOWS), "window", "retention_pct"
    ).withColumn("window", labels[F.col("window")])


def retention_wide(long: DataFrame) -> DataFrame:
    """Back to one row per cohort with a column per window."""
    return (
        long.groupBy("cohort_month")
        .pivot("window", list(RETENTION_WINDOWS.values()))
        .agg(F.first("retention_pct"))
        .orderBy("cohort_month")
    )


def typed_rfm(rfm: DataFrame) -> DataFrame:
    whole = ("r_score", "f_score", "m_score", "total_orders", "days_since_last_order")
    types = {c: "bigint" for c in whole} | {"total_spend": "double"}
    return rfm.select(
        *[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in rfm.columns]
    )


def sample_rows(df: DataFrame, id_column: str, max_rows: int = 5000, seed: int = 42) -> DataFrame:
    """At most ``max_rows`` rows, the same ones on every run.

    A top-k by hash of the id: each task keeps ``max_rows`` rows, nothing is sorted
    as a whole.
    """
    draw = F.md5(F.concat_ws(":", F.col(id_column).cast("string"), F.lit(str(seed))))
    return df.orderBy(draw, id_column).limit(max_rows)


def with_segments(rfm: DataFrame, segments: Sequence[str]) -> DataFrame:
    return rfm.where(F.col("segment").isin(*segments))


def segment_counts(rfm: DataFrame) -> DataFrame:
    def of(segment: str):
        return F.count(F.when(F.col("segment") == segment, 1))

    return rfm.agg(
        F.count(F.lit(1)).alias("total_customers"),
        of("Champion").alias("champions"),
        of("At Risk").alias("at_risk"),
        of("Lost").alias("lost"),
    )


def risk_seller_frame(sellers: DataFrame) -> DataFrame:
    return analyses.revenue_risk_sellers(sellers).drop("review_score_bucket")
