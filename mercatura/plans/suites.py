"""The checks of every table, as data. All entries are fixed values."""

from __future__ import annotations

from mercatura.operators.quality import (
    BETWEEN,
    IN_SET,
    NOT_NULL,
    ROW_COUNT,
    UNIQUE,
    UNIQUE_SHARE,
    accepted_values,
    not_null,
    relationship,
    unique,
)

ORDER_STATUSES = [
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "approved",
    "created",
]

# Gate before the load: raw tables.
SUITES: dict[str, list[dict]] = {
    "orders": [
        {"expectation_type": ROW_COUNT, "kwargs": {"min_value": 90_000, "max_value": None}},
        {"expectation_type": NOT_NULL, "kwargs": {"column": "order_id"}},
        {"expectation_type": UNIQUE, "kwargs": {"column": "order_id"}},
        {
            "expectation_type": IN_SET,
            "kwargs": {"column": "order_status", "value_set": ORDER_STATUSES},
        },
        {"expectation_type": NOT_NULL, "kwargs": {"column": "order_purchase_timestamp"}},
    ],
    "order_items": [
        {"expectation_type": NOT_NULL, "kwargs": {"column": "order_id"}},
        {"expectation_type": NOT_NULL, "kwargs": {"column": "product_id"}},
        {"expectation_type": NOT_NULL, "kwargs": {"column": "seller_id"}},
        {
            "expectation_type": BETWEEN,
            "kwargs": {"column": "price", "min_value": 0, "strict_min": True, "max_value": None},
        },
        {
            "expectation_type": BETWEEN,
            "kwargs": {
                "column": "freight_value",
                "min_value": 0,
                "strict_min": False,
                "max_value": None,
            },
        },
    ],
    "reviews": [
        {"expectation_type": NOT_NULL, "kwargs": {"column": "review_id"}},
        {
            "expectation_type": UNIQUE_SHARE,
            "kwargs": {"column": "review_id", "min_value": 0.90, "max_value": 1.0},
        },
        {"expectation_type": NOT_NULL, "kwargs": {"column": "order_id"}},
        {
            "expectation_type": BETWEEN,
            "kwargs": {"column": "review_score", "min_value": 1, "max_value": 5},
        },
        {"expectation_type": NOT_NULL, "kwargs": {"column": "review_creation_date"}},
    ],
}

# Column that tells a table's age, with the warning and error limits in days.
FRESHNESS = {
    "orders": ("order_purchase_timestamp", 3200, 3500),
    "order_items": ("shipping_limit_date", 3200, 3500),
    "reviews": ("review_creation_date", 3200, 3500),
}

PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
FIVE = [1, 2, 3, 4, 5]
SEGMENTS = [
    "Champion",
    "Loyal",
    "New Customer",
    "Potential Loyalist",
    "At Risk",
    "Lost",
    "Cant Lose Them",
    "Needs Attention",
]

# Tests of the models after a build, layer by layer.
STAGING_TESTS: dict[str, list[dict]] = {
    "stg_customers": [
        not_null("customer_key"),
        not_null("customer_id"),
        unique("customer_id"),
        not_null("customer_unique_id"),
        not_null("zip_code_prefix"),
    ],
    "stg_sellers": [
        not_null("seller_key"),
        unique("seller_key"),
        not_null("seller_id"),
        unique("seller_id"),
        not_null("zip_code_prefix"),
    ],
    "stg_products": [
        not_null("product_key"),
        unique("product_key"),
        not_null("product_id"),
        unique("product_id"),
    ],
    "stg_geolocation": [
        not_null("geolocation_key"),
        unique("geolocation_key"),
        not_null("zip_code_prefix"),
        unique("zip_code_prefix"),
        not_null("latitude"),
        not_null("longitude"),
    ],
    "stg_orders": [
        not_null("order_key"),
        unique("order_key"),
        not_null("order_id"),
        unique("order_id"),
        not_null("customer_id"),
        not_null("order_status"),
        accepted_values("order_status", ORDER_STATUSES),
        not_null("order_purchase_timestamp"),
        not_null("order_estimated_delivery_date"),
    ],
    "stg_order_items": [
        not_null("order_item_key"),
        unique("order_item_key"),
        not_null("order_id"),
        not_null("order_item_id"),
        not_null("product_id"),
        not_null("seller_id"),
        not_null("price"),
        not_null("freight_value"),
    ],
    "stg_payments": [
        not_null("payment_key"),
        unique("payment_key"),
        not_null("order_id"),
        not_null("payment_sequential"),
        not_null("payment_type"),
        accepted_values("payment_type", PAYMENT_TYPES),
        not_null("payment_installments"),
        not_null("payment_value"),
    ],
    "stg_reviews": [
        not_null("review_key"),
        unique("review_key"),
        not_null("review_id"),
        not_null("order_id"),
        not_null("review_score"),
        accepted_values("review_score", FIVE),
        not_null("review_creation_date"),
    ],
}

INTERMEDIATE_TESTS: dict[str, list[dict]] = {
    "int_orders_enriched": [
        not_null("order_id"),
        unique("order_id"),
        not_null("customer_id"),
        relationship("customer_id", "stg_customers", "customer_id"),
        not_null("total_order_value"),
    ],
    "int_order_items_enriched": [
        not_null("order_item_key"),
        unique("order_item_key"),
        not_null("seller_id"),
        relationship("seller_id", "stg_sellers", "seller_id"),
    ],
    "int_delivery_analysis": [not_null("order_id"), not_null("corridor")],
}

_FLAG = [0, 1]

MART_TESTS: dict[str, list[dict]] = {
    "mart_category_performance": [
        not_null("category_name_english"),
        unique("category_name_english"),
        not_null("order_count"),
        not_null("total_revenue"),
        not_null("avg_review_score"),
    ],
    "mart_customer_cohorts": [
        not_null("customer_unique_id"),
        unique("customer_unique_id"),
        not_null("cohort_month"),
        not_null("first_order_date"),
        not_null("total_orders"),
        not_null("repeat_within_30d"),
        accepted_values("repeat_within_30d", _FLAG),
        not_null("repeat_within_60d"),
        accepted_values("repeat_within_60d", _FLAG),
        not_null("repeat_within_90d"),
        accepted_values("repeat_within_90d", _FLAG),
        not_null("is_repeat_customer"),
        accepted_values("is_repeat_customer", _FLAG),
    ],
    "mart_delivery_analysis": [
        not_null("corridor"),
        unique("corridor"),
        not_null("origin_state"),
        not_null("destination_state"),
        not_null("order_count"),
        not_null("late_pct"),
        not_null("delay_rank"),
    ],
    "mart_payment_behavior": [
        not_null("dimension_type"),
        accepted_values("dimension_type", ["installment_bucket", "payment_type"]),
        not_null("dimension_value"),
        not_null("order_count"),
        not_null("avg_order_value"),
        not_null("cancellation_rate_pct"),
    ],
    "mart_rfm_segmentation": [
        not_null("customer_unique_id"),
        unique("customer_unique_id"),
        not_null("total_orders"),
        not_null("total_spend"),
        not_null("days_since_last_order"),
        not_null("r_score"),
        accepted_values("r_score", FIVE),
        not_null("f_score"),
        accepted_values("f_score", FIVE),
        not_null("m_score"),
        accepted_values("m_score", FIVE),
        not_null("rfm_total"),
        not_null("segment"),
        accepted_values("segment", SEGMENTS),
    ],
    "mart_seller_performance": [
        not_null("seller_id"),
        unique("seller_id"),
        not_null("seller_state"),
        not_null("total_revenue"),
        not_null("on_time_pct"),
        not_null("revenue_quartile"),
        accepted_values("revenue_quartile", [1, 2, 3, 4]),
        not_null("review_quartile"),
        accepted_values("review_quartile", [1, 2, 3, 4]),
        not_null("active_months"),
        not_null("review_score_bucket"),
        accepted_values("review_score_bucket", ["High (4-5)", "Medium (3-4)", "Low (<3)"]),
    ],
}

SEED_TESTS: dict[str, list[dict]] = {
    "category_translation": [
        not_null("product_category_name"),
        unique("product_category_name"),
        not_null("product_category_name_english"),
    ],
}
