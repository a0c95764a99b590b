"""Staging, intermediate and mart models."""

from __future__ import annotations

from oracles.duck import key
from oracles.entries import register

ORDER_TIMES = (
    "order_purchase_timestamp t, order_approved_at t, order_delivered_carrier_date t, "
    "order_delivered_customer_date t, order_estimated_delivery_date t"
)

STG_ORDERS = f"order_id i, customer_id i, order_key s, order_status s, {ORDER_TIMES}"
register(
    "stg_orders",
    STG_ORDERS,
    lambda m: m.stg_orders,
    f"select *, {key('order_id')} as order_key from m_orders",
)

STG_CUSTOMERS = (
    "customer_id i, customer_unique_id i, customer_key s, zip_code_prefix s, "
    "customer_city s, customer_state s"
)
register(
    "stg_customers",
    STG_CUSTOMERS,
    lambda m: m.stg_customers,
    f"select *, {key('customer_unique_id')} as customer_key from m_customers",
)

register(
    "stg_sellers",
    "seller_id i, seller_key s, zip_code_prefix s, seller_city s, seller_state s",
    lambda m: m.stg_sellers,
    f"select *, {key('seller_id')} as seller_key from m_sellers",
)

register(
    "stg_products",
    "product_id i, product_key s, category_name_pt s, category_name_en s, name_length i, "
    "description_length i, photos_qty i, weight_g d, length_cm d, height_cm d, width_cm d",
    lambda m: m.stg_products,
    f"select *, {key('product_id')} as product_key from m_products",
)

register(
    "stg_geolocation",
    "zip_code_prefix s, geolocation_key s, latitude d, longitude d, city s, state s",
    lambda m: m.stg_geolocation,
    f"select *, {key('zip_code_prefix')} as geolocation_key from m_geo",
)

register(
    "stg_payments",
    "order_id i, payment_sequential i, payment_key s, payment_type s, "
    "payment_installments i, payment_value d",
    lambda m: m.stg_payments,
    f"select *, {key('order_id', 'payment_sequential')} as payment_key, "
    "value_c / 1e2 as payment_value from m_payments",
)

STG_ITEMS = (
    "order_id i, order_item_id i, product_id i, seller_id i, order_item_key s, "
    "shipping_limit_date t, price d, freight_value d"
)
register(
    "stg_order_items",
    STG_ITEMS,
    lambda m: m.stg_order_items,
    f"select *, {key('order_id', 'order_item_id')} as order_item_key, price_c / 1e2 as price, "
    "freight_c / 1e2 as freight_value from m_items",
)

STG_REVIEWS = (
    "review_id i, order_id i, review_key s, review_score i, comment_title s, "
    "comment_message s, review_creation_date t, review_answer_timestamp t"
)
register(
    "stg_reviews",
    STG_REVIEWS,
    lambda m: m.stg_reviews,
    f"select *, {key('review_id', 'order_id')} as review_key from m_reviews",
)

register(
    "int_orders_enriched",
    f"order_id i, order_key s, customer_id i, order_status s, {ORDER_TIMES}, "
    "delivery_delay_days d, is_on_time i, total_order_value d, max_installments d, "
    "payment_count d, review_score d, review_creation_date t, customer_state s",
    lambda m: m.int_orders_enriched,
    f"select *, {key('order_id')} as order_key, value_c / 1e2 as total_order_value from x_orders",
)

register(
    "int_order_items_enriched",
    "order_id i, order_item_id i, order_item_key s, product_id i, seller_id i, "
    "category_name_pt s, category_name_english s, weight_g d, photos_qty i, price d, "
    "freight_value d, shipping_limit_date t, freight_pct_of_price d, seller_state s, "
    "seller_city s",
    lambda m: m.int_order_items_enriched,
    f"select *, {key('order_id', 'order_item_id')} as order_item_key, price_c / 1e2 as price, "
    "freight_c / 1e2 as freight_value, share_c / 1e2 as freight_pct_of_price from x_items",
)

register(
    "int_customer_enriched",
    "order_id i, customer_unique_id i, order_purchase_timestamp t, order_value d, "
    "order_sequence i, first_order_timestamp t, days_since_first_order i, cohort_month t",
    lambda m: m.int_customer_enriched,
    "select *, value_c / 1e2 as order_value from x_customer",
)

register(
    "int_delivery_analysis",
    "order_id i, order_item_id i, seller_id i, origin_state s, destination_state s, "
    "corridor s, price d, freight_value d, order_purchase_timestamp t, "
    "order_estimated_delivery_date t, order_delivered_customer_date t, order_status s, "
    "actual_delivery_days i, estimated_delivery_days i, delay_days i, is_on_time i",
    lambda m: m.int_delivery_analysis,
    "select *, price_c / 1e2 as price, freight_c / 1e2 as freight_value from x_delivery",
)

CATEGORY = (
    "category_name_english s, order_count i, item_count i, total_revenue d, "
    "avg_item_price d, avg_freight_value d, avg_freight_pct d, avg_review_score d, "
    "avg_delay_days d, avg_weight_g d"
)
register(
    "mart_category_performance",
    CATEGORY,
    lambda m: m.mart_category_performance,
    "select * from mart_category",
)

register(
    "mart_customer_cohorts",
    "customer_unique_id i, cohort_month t, first_order_date t, last_order_date t, "
    "total_orders i, customer_tenure_days i, repeat_within_30d i, repeat_within_60d i, "
    "repeat_within_90d i, is_repeat_customer i",
    lambda m: m.mart_customer_cohorts,
    "select * from mart_cohorts",
)

CORRIDORS = (
    "delay_rank i, corridor s, origin_state s, destination_state s, order_count i, "
    "avg_delay_days d, avg_actual_delivery_days d, avg_estimated_delivery_days d, "
    "late_pct d, avg_freight_value d"
)
register(
    "mart_delivery_analysis",
    CORRIDORS,
    lambda m: m.mart_delivery_analysis,
    "select * from mart_delivery",
)

PAYMENT = (
    "dimension_type s, dimension_value s, order_count i, avg_order_value d, "
    "total_revenue d, avg_review_score d, cancellation_rate_pct d"
)
register(
    "mart_payment_behavior",
    PAYMENT,
    lambda m: m.mart_payment_behavior,
    "select * from mart_payment",
)

register(
    "mart_rfm_segmentation",
    "customer_unique_id i, last_order_date t, first_order_date t, total_orders i, "
    "total_spend d, avg_review_score d, days_since_last_order i, r_score i, f_score i, "
    "m_score i, rfm_total i, segment s",
    lambda m: m.mart_rfm_segmentation,
    "select * from mart_rfm",
)

SELLER = (
    "seller_id i, seller_state s, seller_city s, order_count i, total_revenue d, "
    "avg_review_score d, on_time_pct d, avg_delay_days d, revenue_quartile i, "
    "review_quartile i, active_months i, review_score_bucket s"
)
register(
    "mart_seller_performance",
    SELLER,
    lambda m: m.mart_seller_performance,
    "select * from mart_seller",
)
