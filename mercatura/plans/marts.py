"""The six marts.

The reference result of a mart is an aggregate over items joined with their
order, so an order's attributes count once per item (or per payment row). Here
items are first counted per order and group, and the order's attributes are then
weighted with that count: the same numbers, but the join and everything after it
run on the smaller, already combined rows, and an order or seller that holds a
third of all items arrives as one row per map task.

Each mart is a function of tables, and of ``order_facts`` (``..._of_facts``) where several marts
are made of facts and items that are stored once. Both lead to one function with the measures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.functions.calendar import days_between, month_start, months_between
from mercatura.functions.measures import (
    mean,
    money_sum,
    percentage,
    rounded_ratio,
    weighted_mean,
    weighted_sum,
)
from mercatura.operators.dedupe import mark_first_copy
from mercatura.operators.distinct import distinct_count
from mercatura.operators.selection import Shares, with_shares
from mercatura.plans.enrich import (
    arrived,
    corridor,
    delivered,
    delivered_with_corridor_end,
    delivery_delay_days,
    delivery_times,
    freight_pct_of_price,
    is_on_time,
    live_orders,
    seller_origins,
    with_customer,
    with_latest_review,
    with_payment_summary,
)

# A corridor needs this many items to be listed.
CORRIDOR_FLOOR = 10


def _orders_of_group(approximate: bool) -> Column:
    """The number of different orders, where a group has one row per copy of an order in the
    orders table and the copies are marked (``mark_first_copy``): a sum, where counting distinct
    values would hold every order of every group."""
    if approximate:
        return distinct_count(F.col("order_id"), approximate)
    return F.count(F.when(F.col("first_copy"), 1))


def _rows_of_orders(facts: DataFrame) -> DataFrame:
    """One of the rows of ``order_facts`` for each row of the orders."""
    return facts.where("once")


# ── Category performance ─────────────────────────────────────────────────────


def items_per_order_and_category(order_items: DataFrame, products: DataFrame) -> DataFrame:
    about = products.select(
        "product_id", F.col("category_name_en").alias("category_name_english"), "weight_g"
    )
    share = freight_pct_of_price()
    return (
        order_items.join(about, "product_id", "left")
        .where(F.col("category_name_english").isNotNull())
        .groupBy("order_id", "category_name_english")
        .agg(
            F.count(F.lit(1)).alias("items"),
            money_sum(F.col("price")).alias("price"),
            F.count("price").alias("priced"),
            money_sum(F.col("freight_value")).alias("freight"),
            F.count("freight_value").alias("freighted"),
            money_sum(share).alias("freight_pct"),
            F.count(share).alias("shared"),
            money_sum(F.col("weight_g")).alias("weight"),
            F.count("weight_g").alias("weighed"),
        )
    )


def _category_measures(weight: Column, approximate: bool) -> list[Column]:
    def summed(total: str, count: str, places: int) -> Column:
        return rounded_ratio(F.sum(total), F.sum(count), places)

    return [
        _orders_of_group(approximate).alias("order_count"),
        F.sum("items").alias("item_count"),
        F.round(F.sum("price"), 2).alias("total_revenue"),
        summed("price", "priced", 2).alias("avg_item_price"),
        summed("freight", "freighted", 2).alias("avg_freight_value"),
        summed("freight_pct", "shared", 1).alias("avg_freight_pct"),
        weighted_mean(F.col("review_score"), weight, 2).alias("avg_review_score"),
        weighted_mean(F.col("delivery_delay_days"), weight, 1).alias("avg_delay_days"),
        summed("weight", "weighed", 0).alias("avg_weight_g"),
    ]


def mart_category_performance(
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    reviews: DataFrame,
    once_per_order: bool = False,
    approximate: bool = False,
) -> DataFrame:
    """Delivered sales by English category.

    As defined, review and delay are averaged over items; ``once_per_order``
    averages them over the category's orders instead. ``approximate`` counts the
    orders by a sketch.
    """
    done = delivered(orders).select("order_id", delivery_delay_days().alias("delivery_delay_days"))
    outcomes = with_latest_review(mark_first_copy(done, "order_id", "first_copy"), reviews)
    return _category_performance(outcomes, order_items, products, once_per_order, approximate)


def category_performance_of_facts(
    facts: DataFrame, order_items: DataFrame, products: DataFrame
) -> DataFrame:
    outcomes = delivered(_rows_of_orders(facts)).select(
        "order_id", "first_copy", "review_score", delivery_delay_days().alias("delivery_delay_days")
    )
    return _category_performance(outcomes, order_items, products)


def _category_performance(
    outcomes: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    once_per_order: bool = False,
    approximate: bool = False,
) -> DataFrame:
    per_order = items_per_order_and_category(order_items, products).join(outcomes, "order_id")
    weight = F.lit(1) if once_per_order else F.col("items")
    return per_order.groupBy("category_name_english").agg(*_category_measures(weight, approximate))


def touched_categories(changed: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """The categories whose figures can depend on the orders of ``changed`` (order_id)."""
    ids = changed.select("order_id").distinct()
    items = order_items.select("order_id", "product_id").join(ids, "order_id", "left_semi")
    about = products.select("product_id", F.col("category_name_en").alias("category_name_english"))
    return items.join(about, "product_id").select("category_name_english").distinct()


def refresh_category_performance(
    mart: DataFrame,
    touched: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """``mart`` with the groups of ``touched`` computed anew and all others as they are.

    Only the items of touched categories, and the orders these belong to, take part.
    """
    name = F.col("category_name_en") == F.col("category_name_english")
    some = products.join(touched, name, "left_semi")
    items = order_items.join(some.select("product_id"), "product_id", "left_semi")
    fresh = mart_category_performance(orders, items, some, reviews)
    return mart.join(touched, "category_name_english", "left_anti").unionByName(fresh)


# ── Customer cohorts ─────────────────────────────────────────────────────────


def mart_customer_cohorts(
    orders: DataFrame, customers: DataFrame, approximate: bool = False
) -> DataFrame:
    """Each person's first month, tenure and repeat purchases.

    An order 1..N days after the first exists exactly when the person's second
    distinct order day is at most N days after the first day. So the orders are
    reduced to one row per person and day, which bounds a busy person by the
    length of the calendar, and only first and second day are compared.
    """
    placed = with_customer(live_orders(orders), customers, "customer_unique_id")
    return _customer_cohorts(placed, approximate)


def customer_cohorts_of_facts(facts: DataFrame) -> DataFrame:
    return _customer_cohorts(live_orders(facts))


def _customer_cohorts(placed: DataFrame, approximate: bool = False) -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    days = placed.groupBy("customer_unique_id", F.to_date(ts).alias("day")).agg(
        # An order given twice is one order; its copies have one day.
        distinct_count(F.col("order_id"), approximate).alias("orders"),
        F.min(ts).alias("first"),
        F.max(ts).alias("last"),
    )
    in_person = Window.partitionBy("customer_unique_id").orderBy(F.col("day").asc_nulls_last())
    gaps = days.withColumn("next_day", F.lead("day").over(in_person)).withColumn(
        "place", F.row_number().over(in_person)
    )
    gap = F.when(F.col("place") == 1, F.datediff("next_day", "day"))
    people = gaps.groupBy("customer_unique_id").agg(
        F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"),
        F.sum("orders").alias("total_orders"),
        F.max(gap).alias("gap"),
    )

    def within(days: int) -> Column:
        return F.when(F.col("gap").between(1, days), 1).otherwise(0)

    first, last = F.col("first_order_date"), F.col("last_order_date")
    return people.select(
        "customer_unique_id",
        month_start(first).alias("cohort_month"),
        "first_order_date",
        "last_order_date",
        "total_orders",
        days_between(first, last).alias("customer_tenure_days"),
        within(30).alias("repeat_within_30d"),
        within(60).alias("repeat_within_60d"),
        within(90).alias("repeat_within_90d"),
        F.when(F.col("total_orders") > 1, 1).otherwise(0).alias("is_repeat_customer"),
    )


# ── Delivery corridors ───────────────────────────────────────────────────────


def mart_delivery_analysis(
    orders: DataFrame,
    order_items: DataFrame,
    sellers: DataFrame,
    customers: DataFrame,
    floor: int = CORRIDOR_FLOOR,
) -> DataFrame:
    """Corridors with at least ``floor`` delivered items, worst average delay first.

    All times are an order's, so its items are counted per seller first: an order that holds
    very many items reaches both joins as one row per seller.
    """
    return _delivery_analysis(
        delivered_with_corridor_end(orders, customers), order_items, sellers, floor
    )


def delivery_analysis_of_facts(
    facts: DataFrame, order_items: DataFrame, sellers: DataFrame
) -> DataFrame:
    ends = arrived(facts).withColumnRenamed("customer_state", "destination_state")
    return _delivery_analysis(ends, order_items, sellers)


def _delivery_analysis(
    ends: DataFrame, order_items: DataFrame, sellers: DataFrame, floor: int = CORRIDOR_FLOOR
) -> DataFrame:
    ends = ends.select("order_id", "destination_state", *delivery_times())
    per_order = order_items.groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("items"),
        money_sum(F.col("freight_value")).alias("freight"),
        F.count("freight_value").alias("freighted"),
    )
    items = F.col("items")
    corridors = (
        per_order.join(ends, "order_id")
        .join(seller_origins(sellers), "seller_id", "left")
        .groupBy("origin_state", "destination_state", corridor().alias("corridor"))
        .agg(
            F.sum("items").alias("order_count"),
            weighted_mean(F.col("delay_days"), items, 1).alias("avg_delay_days"),
            weighted_mean(F.col("actual_delivery_days"), items, 1).alias("avg_actual_delivery_days"),
            weighted_mean(F.col("estimated_delivery_days"), items, 1).alias("avg_estimated_delivery_days"),
            percentage(F.col("is_on_time") == 0, 1, items).alias("late_pct"),
            rounded_ratio(F.sum("freight"), F.sum("freighted"), 2).alias("avg_freight_value"),
        )
        .where(F.col("order_count") >= floor)
    )
    # One row per pair of states: the window holds at most states² rows.
    worst_first = Window.orderBy(
        F.col("avg_delay_days").desc_nulls_last(),
        F.col("corridor").asc_nulls_last(),
        F.col("origin_state").asc_nulls_last(),
        F.col("destination_state").asc_nulls_last(),
    )
    return corridors.withColumn("delay_rank", F.row_number().over(worst_first))


# ── Payment behaviour ────────────────────────────────────────────────────────


def installment_bucket() -> Column:
    # Bucket labels and bounds; 0 falls through to '2-3'.
    most = F.col("max_installments")
    return (
        F.when(most == 1, "1 (cash/single)")
        .when(most <= 3, "2-3")
        .when(most <= 6, "4-6")
        .when(most <= 12, "7-12")
        .otherwise("13+")
    )


def payments_per_type(payments: DataFrame) -> DataFrame:
    """A row per order and payment type with its payments, each with the totals of the order;
    ``first_type`` is true for one row of each order.

    An order with very many payments shrinks to its few types on the map side, so the window meets
    an order's types, in the sort by order that a join needs anyway.
    """
    per_type = payments.groupBy("order_id", "payment_type").agg(
        F.count(F.lit(1)).alias("type_rows"),
        money_sum(F.col("payment_value")).alias("paid"),
        F.max("payment_installments").alias("installments"),
    )
    order = Window.partitionBy("order_id")
    return per_type.where(F.col("order_id").isNotNull()).select(
        "order_id",
        "payment_type",
        "type_rows",
        F.sum("paid").over(order).cast("decimal(20,2)").alias("paid"),
        F.max("installments").over(order).alias("max_installments"),
        F.sum("type_rows").over(order).alias("payment_count"),
        (F.row_number().over(order.orderBy("order_id")) == 1).alias("first_type"),
    )


def mart_payment_behavior(
    orders: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    once_per_order: bool = False,
    approximate: bool = False,
) -> DataFrame:
    """Two grains in one table: by installment bucket and by payment type.

    As defined, an order's value counts once per payment row;
    ``once_per_order`` counts it once per group. Each order is emitted once for
    its bucket, with the first of its payment types, and once per payment type, so both
    grains come from one pass.
    """
    # An order without payments is in no group.
    marked = mark_first_copy(orders.select("order_id", "order_status"), "order_id", "first_copy")
    known = with_latest_review(marked.join(payments_per_type(payments), "order_id"), reviews)
    return _payment_behavior(known, once_per_order, approximate)


def payment_behavior_of_facts(facts: DataFrame) -> DataFrame:
    paid = _rows_of_orders(facts).where(F.col("payment_types").isNotNull())
    known = paid.select(
        "order_id",
        "first_copy",
        "order_status",
        "review_score",
        F.col("total_order_value").alias("paid"),
        "max_installments",
        "payment_count",
        F.posexplode("payment_types").alias("place", "type"),
    )
    return _payment_behavior(
        known.select("*", "type.*", (F.col("place") == 0).alias("first_type"))
    )


def _payment_behavior(
    known: DataFrame, once_per_order: bool = False, approximate: bool = False
) -> DataFrame:
    def group(dimension: str, value: Column, rows: Column) -> Column:
        weight = F.lit(1).cast("bigint") if once_per_order else rows
        return F.struct(
            F.lit(dimension).alias("dimension_type"),
            value.alias("dimension_value"),
            weight.alias("weight"),
        )

    has_bucket = F.col("first_type") & F.col("max_installments").isNotNull()
    bucket = group("installment_bucket", installment_bucket(), F.col("payment_count"))
    of_type = group("payment_type", F.col("payment_type"), F.col("type_rows"))
    groups = F.array_compact(
        F.array(F.when(has_bucket, bucket), F.when(F.col("payment_type").isNotNull(), of_type))
    )
    value, weight = F.coalesce("paid", F.lit(0).cast("decimal(20,2)")), F.col("weight")
    return (
        known.select(
            "order_id",
            "first_copy",
            "order_status",
            "review_score",
            value.alias("order_value"),
            F.inline(groups),
        )
        .groupBy("dimension_type", "dimension_value")
        .agg(
            _orders_of_group(approximate).alias("order_count"),
            weighted_mean(F.col("order_value"), weight, 2).alias("avg_order_value"),
            F.round(weighted_sum(F.col("order_value"), weight), 2).alias("total_revenue"),
            weighted_mean(F.col("review_score"), weight, 2).alias("avg_review_score"),
            percentage(F.col("order_status") == "canceled", 1, weight).alias(
                "cancellation_rate_pct"
            ),
        )
    )


# ── RFM segmentation ─────────────────────────────────────────────────────────


def customer_metrics(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    approximate: bool = False,
) -> DataFrame:
    """Recency, frequency and spend per person over delivered orders."""
    done = delivered(orders).select("order_id", "customer_id", "order_purchase_timestamp")
    known = with_customer(done, customers, "customer_unique_id")
    known = with_latest_review(with_payment_summary(known, payments), reviews)
    return _customer_metrics(known, done, approximate)


def _customer_metrics(known: DataFrame, done: DataFrame, approximate: bool = False) -> DataFrame:
    newest = done.agg(F.max("order_purchase_timestamp")).scalar()
    ts = F.col("order_purchase_timestamp")
    return (
        known.groupBy("customer_unique_id")
        .agg(
            F.max(ts).alias("last_order_date"),
            F.min(ts).alias("first_order_date"),
            distinct_count(F.col("order_id"), approximate).alias("total_orders"),
            F.round(F.sum("total_order_value"), 2).alias("total_spend"),
            mean(F.col("review_score"), 2).alias("avg_review_score"),
        )
        .withColumn("days_since_last_order", days_between(F.col("last_order_date"), newest))
    )


def segment() -> Column:
    # Labels and thresholds; the first rule that fits decides.
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champion")
        .when((r >= 3) & (f >= 3), "Loyal")
        .when((r >= 4) & (f <= 2), "New Customer")
        .when((r >= 3) & (f <= 2) & (m >= 3), "Potential Loyalist")
        .when((r <= 2) & (f >= 3) & (m >= 3), "At Risk")
        .when((r == 1) & (f >= 3), "Lost")
        .when((r <= 2) & (m >= 4), "Cant Lose Them")
        .otherwise("Needs Attention")
    )


def mart_rfm_segmentation(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Quintile scores for every person, 5 best, and a segment label."""
    return _rfm_segmentation(customer_metrics(orders, customers, payments, reviews))


def rfm_segmentation_of_facts(facts: DataFrame) -> DataFrame:
    done = delivered(facts)
    return _rfm_segmentation(_customer_metrics(done, done))


def _rfm_segmentation(metrics: DataFrame) -> DataFrame:
    scored = with_shares(
        metrics,
        "customer_unique_id",
        {
            "recency_tile": Shares("days_since_last_order", 5),
            "f_score": Shares("total_orders", 5),
            "m_score": Shares("total_spend", 5),
        },
    )
    return (
        scored.withColumn("r_score", 6 - F.col("recency_tile"))
        .withColumn("rfm_total", F.col("r_score") + F.col("f_score") + F.col("m_score"))
        .select(
            "customer_unique_id",
            "last_order_date",
            "first_order_date",
            "total_orders",
            "total_spend",
            "avg_review_score",
            "days_since_last_order",
            "r_score",
            "f_score",
            "m_score",
            "rfm_total",
            segment().alias("segment"),
        )
    )


# ── Seller performance ───────────────────────────────────────────────────────


def review_score_bucket() -> Column:
    # Bucket labels and bounds; no review at all is 'Low (<3)'.
    score = F.col("review_mean")
    return (
        F.when(score >= 4.0, "High (4-5)").when(score >= 3.0, "Medium (3-4)").otherwise("Low (<3)")
    )


def mart_seller_performance(
    orders: DataFrame,
    order_items: DataFrame,
    sellers: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    once_per_order: bool = False,
    approximate: bool = False,
) -> DataFrame:
    """Sellers with revenue and review quartiles over delivered orders.

    As defined, an order counts once per item of the seller; ``once_per_order``
    counts it once per seller.
    """
    done = delivered(orders).select(
        "order_id",
        "order_purchase_timestamp",
        is_on_time().alias("is_on_time"),
        delivery_delay_days().alias("delivery_delay_days"),
    )
    known = with_latest_review(
        with_payment_summary(mark_first_copy(done, "order_id", "first_copy"), payments), reviews
    )
    return _seller_performance(known, order_items, sellers, once_per_order, approximate)


def seller_performance_of_facts(
    facts: DataFrame, order_items: DataFrame, sellers: DataFrame
) -> DataFrame:
    known = delivered(_rows_of_orders(facts)).select(
        "order_id",
        "first_copy",
        "order_purchase_timestamp",
        "total_order_value",
        "review_score",
        is_on_time().alias("is_on_time"),
        delivery_delay_days().alias("delivery_delay_days"),
    )
    return _seller_performance(known, order_items, sellers)


def _seller_performance(
    known: DataFrame,
    order_items: DataFrame,
    sellers: DataFrame,
    once_per_order: bool = False,
    approximate: bool = False,
) -> DataFrame:
    per_order = order_items.groupBy("order_id", "seller_id").agg(F.count(F.lit(1)).alias("items"))
    weight = F.lit(1) if once_per_order else F.col("items")
    score, ts = F.col("review_score"), F.col("order_purchase_timestamp")
    measured = (
        per_order.join(known, "order_id")
        .groupBy("seller_id")
        .agg(
            _orders_of_group(approximate).alias("order_count"),
            weighted_sum(F.col("total_order_value"), weight).alias("revenue"),
            F.sum(score * weight).alias("score_sum"),
            F.sum(F.when(score.isNotNull(), weight)).alias("score_count"),
            percentage(F.col("is_on_time") == 1, 1, weight).alias("on_time_pct"),
            weighted_mean(F.col("delivery_delay_days"), weight, 1).alias("avg_delay_days"),
            F.min(ts).alias("first_order"),
            F.max(ts).alias("last_order"),
        )
        .withColumn("review_mean", F.col("score_sum").cast("double") / F.col("score_count"))
    )
    # Quartiles go by the unrounded averages. A seller without a review sorts last.
    ranked = with_shares(
        measured,
        "seller_id",
        {
            "revenue_quartile": Shares("revenue", 4),
            "review_quartile": Shares("review_mean", 4),
        },
    )
    places = sellers.select("seller_id", "seller_state", "seller_city")
    return ranked.join(places, "seller_id", "left").select(
        "seller_id",
        "seller_state",
        "seller_city",
        "order_count",
        F.round("revenue", 2).alias("total_revenue"),
        rounded_ratio(F.col("score_sum"), F.col("score_count"), 2).alias("avg_review_score"),
        "on_time_pct",
        "avg_delay_days",
        "revenue_quartile",
        "review_quartile",
        (months_between(F.col("first_order"), F.col("last_order")) + 1).alias("active_months"),
        review_score_bucket().alias("review_score_bucket"),
    )
