"""Dimensions, facts, the daily series, and the corrected-grain marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.plans import marts, star
from mercatura.plans.models import Models
from oracles.duck import avg_rr, key, pct_rr, rr, _BUCKET
from oracles.loads_sql import CUSTOMER_HISTORY, SELLER_HISTORY, customer_history, seller_history
from oracles.models_sql import CATEGORY, PAYMENT, SELLER
from oracles.entries import register

_CALENDAR = """(
  select strftime(d, '%Y%m%d') as date_key, d as full_date, year(d) as year,
         quarter(d) as quarter, month(d) as month, monthname(d) as month_name,
         weekofyear(d) as week_of_year, day(d) as day_of_month, dayname(d) as day_name,
         dayofweek(d) + 1 as day_of_week, dayofweek(d) in (0, 6) as is_weekend,
         dayofweek(d) not in (0, 6) as is_weekday
  from (select unnest(generate_series(min(order_purchase_timestamp)::date,
                                      max(order_purchase_timestamp)::date,
                                      interval 1 day)) as d from m_orders))"""
register(
    "dim_date",
    "date_key s, full_date t, year i, quarter i, month i, month_name s, week_of_year i, "
    "day_of_month i, day_name s, day_of_week i, is_weekend b, is_weekday b",
    lambda m: star.dim_date_spanning(m.stg_orders, "order_purchase_timestamp"),
    f"select * from {_CALENDAR}",
)

register(
    "dim_customers",
    "customer_key s, customer_id i, customer_unique_id i, customer_city s, customer_state s, "
    "customer_zip_code_prefix s, dbt_valid_from t, dbt_valid_to t, is_current b",
    lambda m: star.dim_customers(customer_history(m)),
    f"""select *, {key('customer_id', 'dbt_valid_from')} as customer_key,
       zip_code_prefix as customer_zip_code_prefix, dbt_valid_to is null as is_current
from {CUSTOMER_HISTORY}""",
)
register(
    "dim_sellers",
    "seller_key s, seller_id i, seller_city s, seller_state s, seller_zip_code_prefix s, "
    "dbt_valid_from t, dbt_valid_to t, is_current b",
    lambda m: star.dim_sellers(seller_history(m)),
    f"""select *, {key('seller_id', 'dbt_valid_from')} as seller_key,
       zip_code_prefix as seller_zip_code_prefix,
       dbt_valid_to is null as is_current
from {SELLER_HISTORY}""",
)
register(
    "dim_products",
    "product_key s, product_id i, product_category_name s, product_category_name_english s, "
    "product_weight_g d, product_photos_qty i, product_length_cm d, product_height_cm d, "
    "product_width_cm d",
    lambda m: star.dim_products(m.stg_products),
    f"""select {key('product_id')} as product_key, product_id,
       category_name_pt as product_category_name,
       category_name_en as product_category_name_english, weight_g as product_weight_g,
       photos_qty as product_photos_qty, length_cm as product_length_cm,
       height_cm as product_height_cm, width_cm as product_width_cm
from m_products""",
)
register(
    "dim_geolocation",
    "zip_code_prefix s, centroid_lat d, centroid_lng d, city s, state s",
    lambda m: star.dim_geolocation(m.stg_geolocation),
    "select *, latitude as centroid_lat, longitude as centroid_lng from m_geo",
)



def _versions(history: str, ident: str) -> str:
    """Versions with their keys and the time from which each one counts: the first one from ever."""
    return f"""(select {ident} as ident, {key(ident, 'dbt_valid_from')} as version_key, dbt_valid_to,
       case when dbt_valid_from > min(dbt_valid_from) over (partition by {ident}) then dbt_valid_from
            else timestamp '0001-01-01' end as counts_from
from {history})"""


def _then(alias: str, ident: str, placed: str) -> str:
    return f"""{alias}.ident = {ident} and {placed} >= {alias}.counts_from
  and ({alias}.dbt_valid_to is null or {placed} < {alias}.dbt_valid_to)"""


def items_fact(m: Models) -> DataFrame:
    return star.fact_order_items(
        m.stg_order_items,
        m.stg_orders,
        star.dim_customers(customer_history(m)),
        star.dim_sellers(seller_history(m)),
    )


def orders_fact(m: Models) -> DataFrame:
    return star.fact_orders(m.stg_orders, star.dim_customers(customer_history(m)))


_ITEMS_FACT = f"""(
select i.order_id, i.order_item_id, {key('o.order_id')} as order_key,
       c.version_key as customer_key, s.version_key as seller_key,
       {key('i.product_id')} as product_key,
       strftime(o.order_purchase_timestamp, '%Y%m%d') as date_key,
       price_c / 1e2 as price, freight_c / 1e2 as freight_value, i.shipping_limit_date
from m_items i left join m_orders o on i.order_id = o.order_id
left join {_versions(CUSTOMER_HISTORY, 'customer_id')} c
  on {_then('c', 'o.customer_id', 'o.order_purchase_timestamp')}
left join {_versions(SELLER_HISTORY, 'seller_id')} s
  on {_then('s', 'i.seller_id', 'o.order_purchase_timestamp')})"""
_ORDERS_FACT = f"""(
select o.*, {key('o.order_id')} as order_key, c.version_key as customer_key,
       strftime(order_purchase_timestamp, '%Y%m%d') as date_key,
       date_diff('day', order_purchase_timestamp, order_delivered_customer_date)
         as delivery_days,
       date_diff('day', order_purchase_timestamp, order_estimated_delivery_date)
         as estimated_delivery_days,
       order_delivered_customer_date <= order_estimated_delivery_date as is_delivered_on_time
from m_orders o left join {_versions(CUSTOMER_HISTORY, 'customer_id')} c
  on {_then('c', 'o.customer_id', 'o.order_purchase_timestamp')})"""
register(
    "fact_order_items",
    "order_id i, order_item_id i, order_key s, customer_key s, seller_key s, product_key s, "
    "date_key s, price d, freight_value d, shipping_limit_date t",
    items_fact,
    f"select * from {_ITEMS_FACT}",
)
register(
    "fact_orders",
    "order_id i, order_key s, customer_key s, date_key s, order_status s, delivery_days d, "
    "estimated_delivery_days i, is_delivered_on_time b, order_purchase_timestamp t, "
    "order_delivered_customer_date t, order_estimated_delivery_date t",
    orders_fact,
    f"select * from {_ORDERS_FACT}",
)
register(
    "fact_payments",
    "order_id i, payment_sequential i, order_key s, payment_type s, payment_installments i, "
    "payment_value d",
    lambda m: star.fact_payments(m.stg_payments),
    f"select *, {key('order_id')} as order_key, value_c / 1e2 as payment_value from m_payments",
)

register(
    "daily_canceled_orders",
    "date_key s, full_date t, order_count i",
    lambda m: star.daily_orders(
        star.dim_date_spanning(m.stg_orders, "order_purchase_timestamp"),
        m.stg_orders.where(F.col("order_status") == "canceled"),
    ),
    f"""select c.date_key, c.full_date, count(o.order_id) as order_count
from {_CALENDAR} c left join m_orders o
  on c.full_date = o.order_purchase_timestamp::date and o.order_status = 'canceled'
group by 1, 2""",
)
register(
    "join_fan_out",
    "rows_before i, rows_after i, fanned_out_keys i",
    lambda m: star.join_fan_out(m.stg_orders, m.stg_payments, ["order_id"]),
    """select (select count(*) from m_orders) as rows_before, count(*) as rows_after,
       (select count(*) from (select p.order_id from m_orders o join m_payments p
          on o.order_id = p.order_id group by 1 having count(*) > 1)) as fanned_out_keys
from m_orders o left join m_payments p on o.order_id = p.order_id""",
)

def _grain(fact: str, history: str, ident: str, fact_key: str) -> str:
    """The join itself, and its keys that match several versions."""
    versions = _versions(history, ident)
    return f"""select (select count(*) from {fact}) as rows_before, count(*) as rows_after,
       (select count(*) from (select version_key from {versions}
          where version_key in (select {fact_key} from {fact}) group by 1 having count(*) > 1))
         as fanned_out_keys, count(v.version_key) as matched
from {fact} f left join {versions} v on f.{fact_key} = v.version_key"""


def _grain_of(fact: DataFrame, dimension: DataFrame, key_column: str) -> DataFrame:
    seen = star.join_fan_out(fact, dimension, [key_column])
    known = dimension.select(key_column).distinct()
    matched = fact.join(known, key_column, "left_semi").agg(F.count(F.lit(1)).alias("matched"))
    return seen.withColumn("one", F.lit(1)).join(matched.withColumn("one", F.lit(1)), "one")


register(
    "star_customer_grain",
    "rows_before i, rows_after i, fanned_out_keys i, matched i",
    lambda m: _grain_of(orders_fact(m), star.dim_customers(customer_history(m)), "customer_key"),
    _grain(_ORDERS_FACT, CUSTOMER_HISTORY, "customer_id", "customer_key"),
)
register(
    "star_seller_grain",
    "rows_before i, rows_after i, fanned_out_keys i, matched i",
    lambda m: _grain_of(items_fact(m), star.dim_sellers(seller_history(m)), "seller_key"),
    _grain(_ITEMS_FACT, SELLER_HISTORY, "seller_id", "seller_key"),
)

# ── Marts with an order counted once per group ───────────────────────────────

register(
    "mart_category_once_per_order",
    CATEGORY,
    lambda m: marts.mart_category_performance(
        m.stg_orders, m.stg_order_items, m.stg_products, m.stg_reviews, once_per_order=True
    ),
    f"""select c.* exclude (avg_review_score, avg_delay_days), o.avg_review_score,
       o.avg_delay_days
from mart_category c join (
  select category_name_english, {avg_rr('review_score', 2)} as avg_review_score,
         {avg_rr('delivery_delay_days', 1)} as avg_delay_days
  from (select distinct category_name_english, o.order_id, review_score, delivery_delay_days
        from x_items i join x_orders o on i.order_id = o.order_id
        where o.order_status = 'delivered')
  group by 1) o using (category_name_english)""",
)

_ONCE = f"""count(*) as order_count, {avg_rr('value_c', 2, 2)} as avg_order_value,
       sum(value_c) / 1e2 as total_revenue, {avg_rr('review_score', 2)} as avg_review_score,
       {pct_rr("order_status = 'canceled'", 1)} as cancellation_rate_pct"""
register(
    "mart_payment_once_per_order",
    PAYMENT,
    lambda m: marts.mart_payment_behavior(
        m.stg_orders, m.stg_payments, m.stg_reviews, once_per_order=True
    ),
    f"""select 'installment_bucket' as dimension_type, {_BUCKET} as dimension_value, {_ONCE}
from x_orders where max_installments is not null group by 2
union all
select 'payment_type', payment_type, {_ONCE}
from (select distinct order_id, payment_type, value_c, review_score, order_status from x_paid
      where payment_type is not null) group by 2""",
)

register(
    "mart_seller_once_per_order",
    SELLER,
    lambda m: marts.mart_seller_performance(
        m.stg_orders,
        m.stg_order_items,
        m.stg_sellers,
        m.stg_payments,
        m.stg_reviews,
        once_per_order=True,
    ),
    f"""select s.* exclude (total_revenue, avg_review_score, on_time_pct, avg_delay_days,
                     revenue_quartile, review_quartile, review_score_bucket),
       o.revenue_c / 1e2 as total_revenue, {rr('score_sum', 'score_count', 2)}
         as avg_review_score, o.on_time_pct, o.avg_delay_days,
       ntile(4) over (order by revenue_c nulls last, seller_id) as revenue_quartile,
       ntile(4) over (order by score_sum / score_count nulls last, seller_id)
         as review_quartile,
       case when score_sum / score_count >= 4 then 'High (4-5)'
            when score_sum / score_count >= 3 then 'Medium (3-4)'
            else 'Low (<3)' end as review_score_bucket
from mart_seller s join (
  select seller_id, sum(value_c) as revenue_c, sum(review_score) as score_sum,
         count(review_score) as score_count, {pct_rr('is_on_time = 1', 1)} as on_time_pct,
         {avg_rr('delivery_delay_days', 1)} as avg_delay_days
  from (select distinct seller_id, o.order_id, value_c, review_score, is_on_time,
               delivery_delay_days
        from x_items i join x_orders o on i.order_id = o.order_id
        where o.order_status = 'delivered')
  group by 1) o using (seller_id)""",
)
