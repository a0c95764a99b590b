"""Quality checks: raw suites, model tests, relationships, freshness, failures."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.operators import quality, quarantine
from mercatura.plans import suites
from mercatura.plans.daily import gate
from mercatura.plans.models import Models, StagedModels
from mercatura.plans.testing import check_models, run_suite
from mercatura.session import staged_path
from oracles.duck import key
from oracles.entries import register

RESULT = (
    "table_name s, check_no i, expectation_type s, column_name s, element_count i, "
    "failed_rows d, observed_value d, success b"
)

SOURCES = {
    "orders": "m_orders",
    "order_items": "(select *, price_c / 1e2 as price, freight_c / 1e2 as freight_value "
    "from m_items)",
    "reviews": "m_raw_reviews",
    "stg_customers": f"(select *, {key('customer_unique_id')} as customer_key from m_customers)",
    "stg_sellers": f"(select *, {key('seller_id')} as seller_key from m_sellers)",
    "stg_products": f"(select *, {key('product_id')} as product_key from m_products)",
    "stg_geolocation": f"(select *, {key('zip_code_prefix')} as geolocation_key from m_geo)",
    "stg_orders": f"(select *, {key('order_id')} as order_key from m_orders)",
    "stg_order_items": f"(select *, {key('order_id', 'order_item_id')} as order_item_key, "
    "price_c as price, freight_c as freight_value from m_items)",
    "stg_payments": f"(select *, {key('order_id', 'payment_sequential')} as payment_key, "
    "value_c as payment_value from m_payments)",
    "stg_reviews": f"(select *, {key('review_id', 'order_id')} as review_key from m_reviews)",
    "int_orders_enriched": "(select *, value_c as total_order_value from x_orders)",
    "int_order_items_enriched": f"(select *, {key('order_id', 'order_item_id')} "
    "as order_item_key from x_items)",
    "int_delivery_analysis": "x_delivery",
    "mart_category_performance": "mart_category",
    "mart_customer_cohorts": "mart_cohorts",
    "mart_delivery_analysis": "mart_delivery",
    "mart_payment_behavior": "mart_payment",
    "mart_rfm_segmentation": "mart_rfm",
    "mart_seller_performance": "mart_seller",
    "category_translation": "(select distinct p_type as product_category_name, "
    "lower(p_type) as product_category_name_english from part where p_type <> 'PROMO')",
    "labels": "labels",
    "documents": "documents",
}


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _check_sql(table: str, number: int, check: dict) -> str:
    kind, kwargs = check["expectation_type"], check["kwargs"]
    source, column = SOURCES[table], kwargs.get("column")
    failed, observed, ok = "null", "null", "null"
    body = f"from {source}"
    if kind == quality.ROW_COUNT:
        observed, ok = "count(*)", f"count(*) >= {kwargs['min_value']}"
    elif kind == quality.NOT_NULL:
        failed = f"count(*) - count({column})"
    elif kind == quality.IN_SET:
        listed = ", ".join(_literal(v) for v in kwargs["value_set"])
        failed = f"count(case when {column} not in ({listed}) then 1 end)"
    elif kind == quality.BETWEEN:
        low = ">" if kwargs.get("strict_min") else ">="
        test = f"{column} {low} {kwargs['min_value']}"
        if kwargs.get("max_value") is not None:
            test += f" and {column} <= {kwargs['max_value']}"
        failed = f"count(case when not ({test}) then 1 end)"
    elif kind == quality.UNIQUE:
        body = f"from (select {column}, count(*) over (partition by {column}) as n from {source})"
        failed = f"count(case when {column} is not null and n > 1 then 1 end)"
    elif kind == quality.UNIQUE_SHARE:
        observed = f"count(distinct {column}) / count({column})"
        ok = f"{observed} between {kwargs['min_value']} and {kwargs['max_value']}"
    else:
        parent = f"select {kwargs['field']} from {SOURCES[kwargs['to']]}"
        failed = f"count(case when {column} is not null and {column} not in ({parent}) then 1 end)"
    if ok == "null":
        ok = f"{failed} = 0"
    named = "null" if column is None else f"'{column}'"
    return (
        f"select '{table}' as table_name, {number} as check_no, '{kind}' as expectation_type, "
        f"{named} as column_name, count(*) as element_count, {failed} as failed_rows, "
        f"{observed} as observed_value, {ok} as success {body}"
    )


def suite_sql(suite: dict[str, list[dict]]) -> str:
    return "\nunion all ".join(
        _check_sql(table, number, check)
        for table, checks in suite.items()
        for number, check in enumerate(checks, start=1)
    )


def raw_results(m: Models) -> DataFrame:
    return run_suite(suites.SUITES, {name: getattr(m.raw, name) for name in suites.SUITES})


for _name in suites.SUITES:
    register(
        f"dq_{_name}_suite",
        RESULT,
        lambda m, name=_name: quality.run_checks(
            getattr(m.raw, name), name, suites.SUITES[name]
        ),
        suite_sql({_name: suites.SUITES[_name]}),
    )

register(
    "dq_staging_tests",
    RESULT,
    lambda m: check_models(m, suites.STAGING_TESTS),
    suite_sql(suites.STAGING_TESTS),
)


def intermediate_results(m: Models) -> DataFrame:
    parents = {"stg_customers": m.stg_customers, "stg_sellers": m.stg_sellers}
    return check_models(m, suites.INTERMEDIATE_TESTS, parents)


register(
    "dq_intermediate_tests", RESULT, intermediate_results, suite_sql(suites.INTERMEDIATE_TESTS)
)

register(
    "dq_mart_tests",
    RESULT,
    lambda m: check_models(StagedModels(m), suites.MART_TESTS),
    suite_sql(suites.MART_TESTS),
)

def seed_results(m: Models) -> DataFrame:
    """The seed tests on the translation of the categories that the products have."""
    names = m.raw.source("part").select(F.col("p_type").alias("product_category_name")).distinct()
    translated = names.join(m.raw.category_translation, "product_category_name")
    return run_suite(suites.SEED_TESTS, {"category_translation": translated})


register(
    "dq_seed_tests",
    RESULT,
    seed_results,
    suite_sql(suites.SEED_TESTS),
)

_LABELS = {"labels": [quality.relationship("doc_id", "documents", "doc_id")]}
register(
    "dq_relationships",
    RESULT,
    lambda m: run_suite(
        _LABELS, {"labels": m.raw.source("labels")}, {"documents": m.raw.source("documents")}
    ),
    suite_sql(_LABELS),
)

# ── Quarantine ───────────────────────────────────────────────────────────────

ITEM_RULES = [
    quality.not_null("seller_id"),
    {
        "expectation_type": quality.BETWEEN,
        "kwargs": {"column": "price", "min_value": 1500, "max_value": 90000, "strict_min": True},
    },
    {"expectation_type": quality.BETWEEN, "kwargs": {"column": "freight_value", "min_value": 100}},
    quality.accepted_values("order_item_id", [1, 2, 3, 4, 5, 6]),
]


def quarantined_items(m: Models) -> DataFrame:
    """Items split by four rules; the counted reasons must be those of the rows that were kept."""
    spark, path = m.raw.spark, staged_path(m.raw.spark, "quarantine")
    items = m.raw.order_items.select(
        "order_id", "order_item_id", F.expr("nullif(seller_id, 7)").alias("seller_id"), "price", "freight_value"
    )
    told = quarantine.split(items, ITEM_RULES, path)
    good = quarantine.good_rows(spark, path, items).withColumn("rules", F.lit("")).withColumn("counted", F.lit(told.good))
    bad = quarantine.bad_rows(spark, path, items).withColumn("rules", F.array_join(quarantine.REASONS, ", "))
    return good.unionByName(bad.drop(quarantine.REASONS).withColumn("counted", F.lit(told.bad)))


register(
    "dq_quarantine",
    "order_id i, order_item_id i, seller_id d, price d, freight_value d, rules s, counted i",
    quarantined_items,
    """with judged as (
  select order_id, order_item_id, nullif(seller_id, 7) as seller_id, price_c / 1e2 as price,
         freight_c / 1e2 as freight_value,
         concat_ws(', ', case when seller_id = 7 then 'seller_id: not_be_null' end,
                   case when price_c <= 150000 or price_c > 9000000 then 'price: be_between' end,
                   case when freight_c < 10000 then 'freight_value: be_between' end,
                   case when order_item_id not in (1, 2, 3, 4, 5, 6) then 'order_item_id: be_in_set' end) as rules
  from m_items)
select *, count(*) over (partition by rules = '') as counted from judged""",
)


def quarantine_reasons(m: Models) -> DataFrame:
    """Rows per reason, as counted while the split was written."""
    told = quarantine.split(m.raw.order_items, ITEM_RULES, staged_path(m.raw.spark, "quarantine"))
    rows = [(rule, told.good, told.bad, n) for rule, n in told.per_rule.items()]
    return m.raw.spark.createDataFrame(rows, "rule string, good bigint, bad bigint, row_count bigint")


register(
    "dq_quarantine_reasons",
    "rule s, good i, bad i, row_count i",
    quarantine_reasons,
    """with judged as (
  select seller_id is null as r1, price_c <= 150000 or price_c > 9000000 as r2, freight_c < 10000 as r3,
         order_item_id not in (1, 2, 3, 4, 5, 6) as r4 from m_items),
totals as (select count(*) filter (not (r1 or r2 or r3 or r4)) as good,
                  count(*) filter (r1 or r2 or r3 or r4) as bad,
                  count(*) filter (r1) as n1, count(*) filter (r2) as n2, count(*) filter (r3) as n3,
                  count(*) filter (r4) as n4 from judged)
select 'seller_id: not_be_null' as rule, good, bad, n1 as row_count from totals
union all select 'price: be_between', good, bad, n2 from totals
union all select 'freight_value: be_between', good, bad, n3 from totals
union all select 'order_item_id: be_in_set', good, bad, n4 from totals""",
)

NOW = dt.datetime(2010, 8, 15)


def freshness(m: Models) -> DataFrame:
    ages = [
        quality.check_freshness(getattr(m.raw, name), name, column, NOW, warn, error)
        for name, (column, warn, error) in suites.FRESHNESS.items()
    ]
    return reduce(DataFrame.unionByName, ages)


def _freshness_sql(table: str, column: str, warn: int, error: int) -> str:
    return f"""select '{table}' as table_name, max({column}) as max_loaded_at,
       case when max({column}) + interval {error} days < timestamp '{NOW}' then 'error'
            when max({column}) + interval {warn} days < timestamp '{NOW}' then 'warn'
            else 'pass' end as status
from {SOURCES[table]}"""


register(
    "dq_freshness",
    "table_name s, max_loaded_at t, status s",
    freshness,
    " union all ".join(
        _freshness_sql(name, *rest) for name, rest in suites.FRESHNESS.items()
    ),
)

RUN_TIME = dt.datetime(2024, 2, 1, 6, 0)
register(
    "dq_failures",
    "table_name s, run_time t, total_failed i, expectation_type s, observed_value d",
    lambda m: quality.failures(raw_results(m), RUN_TIME),
    f"""select table_name, timestamp '{RUN_TIME}' as run_time,
       count(*) over (partition by table_name) as total_failed, expectation_type, observed_value
from ({suite_sql(suites.SUITES)}) where not success""",
)


# One check more, which other states than 'delivered' break at any scale.
_STRICT = {
    name: [*checks, quality.accepted_values("order_status", ["delivered"])] if name == "orders" else checks
    for name, checks in suites.SUITES.items()
}


def gate_run(m: Models) -> DataFrame:
    """The gate over all raw suites: what it recorded, and that it stopped the run."""
    spark, audit = m.raw.spark, staged_path(m.raw.spark, "audit")
    tables = {name: getattr(m.raw, name) for name in suites.SUITES}
    try:
        gate(tables, _STRICT, RUN_TIME, audit)
        stopped = False
    except quality.QualityGateError:
        stopped = True
    kept = spark.read.parquet(audit).select("table_name", "run_time", "total_failed", "expectation_type")
    return kept.withColumn("stopped", F.lit(stopped))


register(
    "dq_gate",
    "table_name s, run_time t, total_failed i, expectation_type s, stopped b",
    gate_run,
    f"""select table_name, timestamp '{RUN_TIME}' as run_time,
       count(*) over (partition by table_name) as total_failed, expectation_type, true as stopped
from ({suite_sql(_STRICT)}) where not success""",
)
