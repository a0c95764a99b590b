"""Analyses and dashboard frames."""

from __future__ import annotations

from mercatura.plans import analyses, dashboard
from oracles.duck import avg_rr, month_diff, pct_rr, rr
from oracles.models_sql import CORRIDORS
from oracles.entries import register

# Marts carry rounded doubles; tenths and hundredths as integers average exactly.
def _avg(column: str, digits: int, places: int) -> str:
    return avg_rr(f"cast(round({column} * {10**digits}) as bigint)", places, digits)


_QUADRANT = """case when revenue_quartile = 4 and review_quartile = 4 then 'Star Sellers'
             when revenue_quartile = 4 and review_quartile <= 2 then 'Revenue Risk'
             when revenue_quartile <= 2 and review_quartile = 4 then 'Hidden Gems'
             else 'Middle Pack' end"""
register(
    "anl_seller_matrix",
    "revenue_quartile i, review_quartile i, quadrant_label s, seller_count i, "
    "avg_on_time_pct d, avg_revenue d, avg_review_score d, avg_delay_days d",
    lambda m: analyses.seller_matrix(m.mart_seller_performance),
    f"""select revenue_quartile, review_quartile, {_QUADRANT} as quadrant_label,
       count(*) as seller_count, {_avg('on_time_pct', 1, 1)} as avg_on_time_pct,
       {_avg('total_revenue', 2, 0)} as avg_revenue,
       {_avg('avg_review_score', 2, 2)} as avg_review_score,
       {_avg('avg_delay_days', 1, 1)} as avg_delay_days
from mart_seller group by 1, 2, 3""",
)

_RISK = """select * from mart_seller where revenue_quartile = 4 and review_quartile <= 2
order by total_revenue desc nulls last, seller_id limit 10"""
register(
    "anl_revenue_risk_sellers",
    "seller_id i, seller_state s, total_revenue d, avg_review_score d, on_time_pct d, "
    "order_count i, review_score_bucket s",
    lambda m: analyses.revenue_risk_sellers(m.mart_seller_performance),
    _RISK,
)

_WORST = "select * from mart_delivery order by delay_rank limit 15"
register(
    "anl_worst_corridors",
    CORRIDORS,
    lambda m: analyses.worst_corridors(m.mart_delivery_analysis),
    _WORST,
)

register(
    "anl_corridor_volume",
    "volume_bucket s, corridor_count i, avg_delay_days d, avg_late_pct d",
    lambda m: analyses.corridor_volume(m.mart_delivery_analysis),
    f"""select case when order_count >= 500 then 'High volume (500+)'
            when order_count >= 100 then 'Mid volume (100-499)'
            else 'Low volume (10-99)' end as volume_bucket,
       count(*) as corridor_count, {_avg('avg_delay_days', 1, 1)} as avg_delay_days,
       {_avg('late_pct', 1, 1)} as avg_late_pct
from mart_delivery group by 1""",
)

_COHORTS = f"""select cohort_month, count(*) as cohort_size,
       {pct_rr('repeat_within_30d = 1', 1)} as retention_30d_pct,
       {pct_rr('repeat_within_60d = 1', 1)} as retention_60d_pct,
       {pct_rr('repeat_within_90d = 1', 1)} as retention_90d_pct,
       {pct_rr('is_repeat_customer = 1', 1)} as lifetime_repeat_pct
from mart_cohorts group by cohort_month having count(*) >= 50"""
register(
    "anl_cohort_retention",
    "cohort_month t, cohort_size i, retention_30d_pct d, retention_60d_pct d, "
    "retention_90d_pct d, lifetime_repeat_pct d",
    lambda m: analyses.cohort_retention(m.mart_customer_cohorts),
    _COHORTS,
)

register(
    "anl_platform_retention",
    "total_customers i, platform_30d_pct d, platform_60d_pct d, platform_90d_pct d, "
    "platform_lifetime_repeat_pct d",
    lambda m: analyses.platform_retention(m.mart_customer_cohorts),
    f"""select count(*) as total_customers,
       {pct_rr('repeat_within_30d = 1', 1)} as platform_30d_pct,
       {pct_rr('repeat_within_60d = 1', 1)} as platform_60d_pct,
       {pct_rr('repeat_within_90d = 1', 1)} as platform_90d_pct,
       {pct_rr('is_repeat_customer = 1', 1)} as platform_lifetime_repeat_pct
from mart_cohorts""",
)

register(
    "anl_installment_buckets",
    "installment_bucket s, order_count i, avg_order_value d, total_revenue d, "
    "avg_review_score d, cancellation_rate_pct d",
    lambda m: analyses.installment_buckets(m.mart_payment_behavior),
    "select *, dimension_value as installment_bucket from mart_payment "
    "where dimension_type = 'installment_bucket'",
)

register(
    "anl_payment_types",
    "payment_type s, order_count i, avg_order_value d, avg_review_score d, "
    "cancellation_rate_pct d",
    lambda m: analyses.payment_types(m.mart_payment_behavior),
    "select *, dimension_value as payment_type from mart_payment "
    "where dimension_type = 'payment_type'",
)


def _delay_bucket(column: str) -> str:
    return f"""case when {column} <= 0 then '1. On time or early'
            when {column} <= 3 then '2. 1-3 days late'
            when {column} <= 7 then '3. 4-7 days late'
            when {column} <= 14 then '4. 8-14 days late'
            else '5. 15+ days late' end"""


register(
    "anl_corridor_delay_buckets",
    "delay_bucket s, corridor_count i, avg_delay_days d, avg_late_pct d, total_orders i",
    lambda m: analyses.corridor_delay_buckets(m.mart_delivery_analysis),
    f"""select {_delay_bucket('avg_delay_days')} as delay_bucket, count(*) as corridor_count,
       {_avg('avg_delay_days', 1, 1)} as avg_delay_days,
       {_avg('late_pct', 1, 1)} as avg_late_pct, sum(order_count) as total_orders
from (select avg_delay_days, late_pct, order_count from mart_delivery) group by 1""",
)

register(
    "anl_lowest_rated_categories",
    "category_name_english s, avg_review_score d, avg_delay_days d, order_count i, "
    "total_revenue d",
    lambda m: analyses.lowest_rated_categories(m.mart_category_performance),
    """select * from mart_category where avg_review_score is not null
order by avg_review_score, category_name_english limit 15""",
)

register(
    "anl_delay_against_low_scores",
    "delay_bucket s, reviewed_orders i, low_score_pct d, avg_review_score d",
    lambda m: analyses.delay_against_low_scores(m.int_orders_enriched),
    f"""select {_delay_bucket('delivery_delay_days')} as delay_bucket,
       count(*) as reviewed_orders, {pct_rr('review_score <= 2', 1)} as low_score_pct,
       {avg_rr('review_score', 2)} as avg_review_score
from x_orders where delivery_delay_days is not null and review_score is not null group by 1""",
)


def _clv(floor: int) -> str:
    """A cell adds up the averages of all cells of its cohort up to its own tenure."""
    tenure = month_diff("c.first_order_date", "r.last_order_date")
    return f"""with spenders as (
  select cohort_month, {tenure} as tenure_months, spend_c
  from mart_cohorts c join rfm_metrics r using (customer_unique_id) where spend_c is not null),
cells as (
  select cohort_month, tenure_months, count(*) as customer_count,
         cast(round({avg_rr('spend_c', 2, 2)} * 100) as bigint) as cents
  from spenders group by all),
cohorts as (select cohort_month from spenders group by all having count(*) >= {floor})
select c.cohort_month, c.tenure_months, c.customer_count,
       c.cents / 1e2 as avg_spend_per_customer, sum(e.cents) / 1e2 as cumulative_avg_clv
from cells c semi join cohorts using (cohort_month)
join cells e on e.cohort_month = c.cohort_month and e.tenure_months <= c.tenure_months
group by c.cohort_month, c.tenure_months, c.customer_count, c.cents"""


CLV = (
    "cohort_month t, tenure_months i, customer_count i, avg_spend_per_customer d, "
    "cumulative_avg_clv d"
)
register(
    "anl_clv_by_cohort",
    CLV,
    lambda m: analyses.clv_by_cohort(m.mart_customer_cohorts, m.customer_metrics),
    _clv(0),
)
register(
    "anl_clv_by_cohort_floor",
    CLV,
    lambda m: analyses.clv_by_cohort(
        m.mart_customer_cohorts, m.customer_metrics, analyses.COHORT_FLOOR
    ),
    _clv(50),
)

# The statuses that have reached each stage.
_REACHED = {
    "created": "created, approved, invoiced, processing, shipped, delivered, canceled, unavailable",
    "approved": "approved, invoiced, processing, shipped, delivered",
    "invoiced": "invoiced, processing, shipped, delivered",
    "processing": "processing, shipped, delivered",
    "shipped": "shipped, delivered",
    "delivered": "delivered",
}
_STAGES = " union all ".join(
    f"select {place} as stage_order, '{name}' as stage_name, '{reached}' as reached"
    for place, (name, reached) in enumerate(_REACHED.items(), start=1)
)
register(
    "anl_order_funnel",
    "stage_order i, stage_name s, stage_count i, prev_stage_count d, "
    "stage_over_stage_pct d, pct_of_top_funnel d",
    lambda m: analyses.order_funnel(m.stg_orders),
    f"""with stages as (
  select stage_order, stage_name, count(distinct order_id) as stage_count
  from ({_STAGES}) s left join m_orders o
    on list_contains(string_split(reached, ', '), o.order_status)
  group by all),
compared as (
  select s.*, p.stage_count as prev_stage_count, t.stage_count as top_count
  from stages s left join stages p on p.stage_order = s.stage_order - 1
  join stages t on t.stage_order = 1)
select stage_order, stage_name, stage_count, prev_stage_count,
       {rr('100 * (stage_count - prev_stage_count)', 'nullif(prev_stage_count, 0)', 1)}
         as stage_over_stage_pct,
       {rr('100 * stage_count', 'nullif(top_count, 0)', 1)} as pct_of_top_funnel
from compared""",
)

# ── Dashboard ────────────────────────────────────────────────────────────────

register(
    "dsh_sellers",
    "seller_id i, seller_state s, total_revenue d, avg_review_score d, on_time_pct d, "
    "order_count i, revenue_quartile i, review_quartile i, review_score_bucket s, "
    "avg_delay_days d",
    lambda m: dashboard.seller_frame(m.mart_seller_performance),
    "select * from mart_seller",
)

_DSH_CORRIDORS = (
    "corridor s, origin_state s, destination_state s, order_count i, avg_delay_days d, "
    "late_pct d, delay_rank i"
)
register(
    "dsh_worst_corridors",
    _DSH_CORRIDORS,
    lambda m: dashboard.corridor_frame(m.mart_delivery_analysis),
    _WORST,
)
register(
    "dsh_corridors_by_delay",
    _DSH_CORRIDORS,
    lambda m: dashboard.corridors_by_delay(dashboard.corridor_frame(m.mart_delivery_analysis)),
    f"select * from ({_WORST}) order by avg_delay_days, corridor",
)

register(
    "dsh_cohort_retention",
    "cohort_month t, cohort_size i, retention_30d d, retention_60d d, retention_90d d",
    lambda m: dashboard.retention_frame(m.mart_customer_cohorts),
    f"select cohort_month, cohort_size, retention_30d_pct as retention_30d, "
    f"retention_60d_pct as retention_60d, retention_90d_pct as retention_90d from ({_COHORTS})",
)
register(
    "dsh_cohort_labels",
    "cohort_month s, cohort_size i, retention_30d d, retention_60d d, retention_90d d",
    lambda m: dashboard.label_cohort_month(dashboard.retention_frame(m.mart_customer_cohorts)),
    f"select strftime(cohort_month, '%Y-%m') as cohort_month, cohort_size, "
    f"retention_30d_pct as retention_30d, retention_60d_pct as retention_60d, "
    f"retention_90d_pct as retention_90d from ({_COHORTS})",
)

_LONG = " union all ".join(
    f"select cohort_month, cohort_size, '{days} Days' as \"window\", "
    f"retention_{days}d_pct as retention_pct from ({_COHORTS})"
    for days in (30, 60, 90)
)
register(
    "dsh_retention_long",
    "cohort_month t, cohort_size i, time_window s, retention_pct d",
    lambda m: dashboard.retention_long(
        dashboard.retention_frame(m.mart_customer_cohorts)
    ).withColumnRenamed("window", "time_window"),
    f'select *, "window" as time_window from ({_LONG})',
)
register(
    "dsh_retention_wide",
    "cohort_month t, days_30 d, days_60 d, days_90 d",
    lambda m: dashboard.retention_wide(
        dashboard.retention_long(analyses.cohort_retention(m.mart_customer_cohorts))
    ).toDF("cohort_month", "days_30", "days_60", "days_90"),
    f"select cohort_month, retention_30d_pct as days_30, retention_60d_pct as days_60, "
    f"retention_90d_pct as days_90 from ({_COHORTS})",
)

register(
    "dsh_installments",
    "dimension_value s, order_count i, avg_order_value d, cancellation_rate_pct d, "
    "avg_review_score d",
    lambda m: dashboard.installment_frame(m.mart_payment_behavior),
    "select * from mart_payment where dimension_type = 'installment_bucket'",
)

_RFM = (
    "customer_unique_id i, r_score i, f_score i, m_score i, segment s, total_spend d, "
    "total_orders i, days_since_last_order i"
)
register(
    "dsh_rfm",
    _RFM,
    lambda m: dashboard.rfm_frame(m.mart_rfm_segmentation),
    "select * from mart_rfm",
)
register(
    "dsh_rfm_typed",
    _RFM,
    lambda m: dashboard.typed_rfm(dashboard.rfm_frame(m.mart_rfm_segmentation)),
    "select * from mart_rfm",
)
register(
    "dsh_rfm_sample",
    _RFM,
    lambda m: dashboard.sample_rows(
        dashboard.rfm_frame(m.mart_rfm_segmentation), "customer_unique_id", max_rows=500
    ),
    "select * from mart_rfm "
    "order by md5(cast(customer_unique_id as varchar) || ':42'), customer_unique_id limit 500",
)
register(
    "dsh_segment_filter",
    _RFM,
    lambda m: dashboard.with_segments(
        dashboard.rfm_frame(m.mart_rfm_segmentation), ["Champion", "At Risk"]
    ),
    "select * from mart_rfm where segment in ('Champion', 'At Risk')",
)
register(
    "dsh_segment_counts",
    "total_customers i, champions i, at_risk i, lost i",
    lambda m: dashboard.segment_counts(m.mart_rfm_segmentation),
    """select count(*) as total_customers,
       count(case when segment = 'Champion' then 1 end) as champions,
       count(case when segment = 'At Risk' then 1 end) as at_risk,
       count(case when segment = 'Lost' then 1 end) as lost
from mart_rfm""",
)

_TENTHS = "cast(round(on_time_pct * 10) as bigint)"
_CELLS = ", ".join(
    f"sum(case when review_quartile = {q} then {_TENTHS} end) / 1e1 / "
    f"count(case when review_quartile = {q} then {_TENTHS} end) as review_q{q}"
    for q in (1, 2, 3, 4)
)
register(
    "dsh_seller_heatmap",
    "revenue_quartile i, review_q1 d, review_q2 d, review_q3 d, review_q4 d",
    lambda m: dashboard.seller_heatmap(m.mart_seller_performance).toDF(
        "revenue_quartile", "review_q1", "review_q2", "review_q3", "review_q4"
    ),
    f"select revenue_quartile, {_CELLS} from mart_seller group by revenue_quartile",
)

register(
    "dsh_risk_sellers",
    "seller_id i, seller_state s, total_revenue d, avg_review_score d, on_time_pct d, "
    "order_count i",
    lambda m: dashboard.risk_seller_frame(m.mart_seller_performance),
    _RISK,
)
