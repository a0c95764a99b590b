"""Edge cases of the analyses and the dashboard frames."""

import datetime as dt
from decimal import Decimal

from mercatura.plans import analyses, dashboard


def test_funnel_counts_the_furthest_stage_once_and_survives_zero(spark):
    rows = [(1, "delivered"), (1, "created"), (2, "canceled"), (3, "shipped"), (4, "odd")]
    orders = spark.createDataFrame(rows, "order_id int, order_status string")
    found = [tuple(r)[1:] for r in analyses.order_funnel(orders).collect()]
    assert [(f[0], f[1]) for f in found] == [
        ("created", 3), ("approved", 2), ("invoiced", 2), ("processing", 2), ("shipped", 2),
        ("delivered", 1),
    ]
    assert found[1][3:] == (Decimal("-33.3"), Decimal("66.7"))
    empty = analyses.order_funnel(orders.limit(0)).collect()
    assert [r.stage_count for r in empty] == [0] * 6
    assert {r.stage_over_stage_pct for r in empty} == {r.pct_of_top_funnel for r in empty} == {None}


def test_installments_come_in_logical_order(spark):
    rows = [("installment_bucket", b) for b in ("7-12", "13+", "2-3", "1 (cash/single)", "4-6")]
    mart = spark.createDataFrame(
        [(*r, 1, 1, 1, 1, 1) for r in [*rows, ("payment_type", "boleto")]],
        "dimension_type string, dimension_value string, order_count int, avg_order_value int, "
        "total_revenue int, avg_review_score int, cancellation_rate_pct int",
    )
    found = [r.installment_bucket for r in analyses.installment_buckets(mart).collect()]
    assert found == list(analyses.BUCKET_ORDER)


def test_retention_round_trip_accepts_both_names(spark):
    month = dt.datetime(2018, 1, 1)
    wide = spark.createDataFrame(
        [(month, 60, 1.0, 2.0, None)],
        "cohort_month timestamp_ntz, cohort_size int, retention_30d_pct double, "
        "retention_60d_pct double, retention_90d_pct double",
    )
    long = dashboard.retention_long(wide)
    assert {(r.window, r.retention_pct) for r in long.collect()} == {
        ("30 Days", 1.0), ("60 Days", 2.0), ("90 Days", None),
    }
    assert tuple(dashboard.retention_wide(long).first()) == (month, 1.0, 2.0, None)
    plain = wide.toDF("cohort_month", "cohort_size", *dashboard.RETENTION_WINDOWS)
    assert dashboard.retention_long(plain).collect() == long.collect()
    assert dashboard.label_cohort_month(plain).first().cohort_month == "2018-01"


def test_sample_is_stable_and_bounded(spark):
    df = spark.range(1000).withColumnRenamed("id", "customer")
    take = lambda n: [r.customer for r in dashboard.sample_rows(df, "customer", n).collect()]
    assert take(100) == take(100) and len(set(take(100))) == 100
    assert len(take(5000)) == 1000
    other = dashboard.sample_rows(df.repartition(7), "customer", 100).collect()
    assert [r.customer for r in other] == take(100)


def test_cohort_floor_drops_whole_cohorts(spark):
    month, other = dt.datetime(2018, 1, 1), dt.datetime(2018, 2, 1)
    cohorts = spark.createDataFrame(
        [(i, month if i < 3 else other, month if i < 3 else other) for i in range(4)],
        "customer_unique_id int, cohort_month timestamp_ntz, first_order_date timestamp_ntz",
    )
    spend = spark.createDataFrame(
        [(0, Decimal(1), month), (1, Decimal(2), month), (2, Decimal(6), other),
         (3, Decimal(9), other), (7, Decimal(9), other)],
        "customer_unique_id int, total_spend decimal(20,2), last_order_date timestamp_ntz",
    )
    rows = [tuple(r) for r in analyses.clv_by_cohort(cohorts, spend).collect()]
    assert rows == [
        (month, 0, 2, Decimal("1.50"), Decimal("1.50")),
        (month, 1, 1, Decimal("6.00"), Decimal("7.50")),
        (other, 0, 1, Decimal("9.00"), Decimal("9.00")),
    ]
    kept = analyses.clv_by_cohort(cohorts, spend, cohort_floor=3).collect()
    assert [tuple(r) for r in kept] == rows[:2]
