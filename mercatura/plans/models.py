"""All models over one set of raw tables; dependencies are plain calls."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame

from mercatura.plans import enrich, marts, staging
from mercatura.session import shuffles_freed, stage


class Models:
    """Lazy models over raw tables: any object with the nine table attributes.

    A stored model can replace a computed one: pass it by name in ``stored``,
    e.g. ``Models(raw, mart_rfm_segmentation=spark.table("rfm"))``.
    """

    def __init__(self, raw, **stored: DataFrame):
        self.raw = raw
        for name, table in stored.items():
            if not hasattr(type(self), name):
                raise ValueError(f"no model named {name}")
            self.__dict__[name] = table

    # Staging

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw.order_items)

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.stg_payments(self.raw.payments)

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return staging.stg_reviews(self.raw.reviews)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.products, self.raw.category_translation)

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.raw.sellers)

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return staging.stg_geolocation(self.raw.geolocation)

    # Intermediate

    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return enrich.int_orders_enriched(
            self.stg_orders, self.stg_customers, self.stg_payments, self.stg_reviews
        )

    @cached_property
    def int_order_items_enriched(self) -> DataFrame:
        return enrich.int_order_items_enriched(
            self.stg_order_items, self.stg_products, self.stg_sellers
        )

    @cached_property
    def int_customer_enriched(self) -> DataFrame:
        return enrich.int_customer_enriched(
            self.stg_orders, self.stg_customers, self.stg_order_items
        )

    @cached_property
    def int_delivery_analysis(self) -> DataFrame:
        return enrich.int_delivery_analysis(
            self.stg_orders, self.stg_order_items, self.stg_sellers, self.stg_customers
        )

    # Marts

    @cached_property
    def mart_category_performance(self) -> DataFrame:
        return marts.mart_category_performance(
            self.stg_orders, self.stg_order_items, self.stg_products, self.stg_reviews
        )

    @cached_property
    def mart_customer_cohorts(self) -> DataFrame:
        return marts.mart_customer_cohorts(self.stg_orders, self.stg_customers)

    @cached_property
    def mart_delivery_analysis(self) -> DataFrame:
        return marts.mart_delivery_analysis(
            self.stg_orders, self.stg_order_items, self.stg_sellers, self.stg_customers
        )

    @cached_property
    def mart_payment_behavior(self) -> DataFrame:
        return marts.mart_payment_behavior(self.stg_orders, self.stg_payments, self.stg_reviews)

    @cached_property
    def customer_metrics(self) -> DataFrame:
        return marts.customer_metrics(
            self.stg_orders, self.stg_customers, self.stg_payments, self.stg_reviews
        )

    @cached_property
    def mart_rfm_segmentation(self) -> DataFrame:
        return marts.mart_rfm_segmentation(
            self.stg_orders, self.stg_customers, self.stg_payments, self.stg_reviews
        )

    @cached_property
    def mart_seller_performance(self) -> DataFrame:
        return marts.mart_seller_performance(
            self.stg_orders,
            self.stg_order_items,
            self.stg_sellers,
            self.stg_payments,
            self.stg_reviews,
        )


class StagedModels(Models):
    """The models with all marts made of two tables staged once: what the marts ask about orders and about
    items. For runs over several marts, as each would join, deduplicate and shuffle these anew.
    """

    def __init__(self, models: Models):
        super().__init__(
            models.raw, stg_products=models.stg_products, stg_sellers=models.stg_sellers
        )
        items = models.stg_order_items.select(
            "order_id", "product_id", "seller_id", "price", "freight_value"
        )
        facts = enrich.order_facts(
            models.stg_orders, models.stg_customers, models.stg_payments, models.stg_reviews
        )
        with shuffles_freed(items.sparkSession), ThreadPoolExecutor(2) as pool:
            self.items, self.facts = pool.map(
                lambda table, name: stage(table, name, "zstd"), (items, facts), ("items", "order-facts")
            )

    @cached_property
    def mart_category_performance(self) -> DataFrame:
        return marts.category_performance_of_facts(self.facts, self.items, self.stg_products)

    @cached_property
    def mart_customer_cohorts(self) -> DataFrame:
        return marts.customer_cohorts_of_facts(self.facts)

    @cached_property
    def mart_delivery_analysis(self) -> DataFrame:
        return marts.delivery_analysis_of_facts(self.facts, self.items, self.stg_sellers)

    @cached_property
    def mart_payment_behavior(self) -> DataFrame:
        return marts.payment_behavior_of_facts(self.facts)

    @cached_property
    def mart_rfm_segmentation(self) -> DataFrame:
        return marts.rfm_segmentation_of_facts(self.facts)

    @cached_property
    def mart_seller_performance(self) -> DataFrame:
        return marts.seller_performance_of_facts(self.facts, self.items, self.stg_sellers)
