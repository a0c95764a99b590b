"""Distinct counts: sketches against exact counts, and marts on orders given twice."""

import pytest
from pyspark.sql import functions as F

from mercatura.operators import distinct, quality
from mercatura.plans.models import Models
from mercatura.session import stage
from mercatura.sources.marketplace import Marketplace
from oracles import models_sql
from oracles.compare import connect, difference
from oracles.duck import CTES, query
from oracles.entries import portable

FOLDER = "/root/testdata/sf0.001"


def test_sketches_of_parts_united_equal_the_sketch_of_all(spark):
    table = spark.range(30_000).select((F.col("id") % 7).alias("part"), (F.col("id") % 9_000).alias("value"))
    parts = stage(distinct.sketch_per(table, ["part"], F.col("value")), "parts")
    whole = distinct.counted(distinct.united(parts, [])).first()
    once = table.agg(distinct.distinct_count(F.col("value"), approximate=True).alias("n")).first().n
    assert whole.row_count == 30_000
    bound = 3 * distinct.relative_error() * 9_000
    assert abs(whole.distinct_count - 9_000) <= bound and abs(once - 9_000) <= bound


def test_error_stays_inside_its_bound(spark):
    """Sets of many sizes; small ones are exact."""
    sizes = spark.range(1, 121).select(F.col("id").alias("k"), (F.pow(F.lit(1.1), F.col("id"))).cast("int").alias("n"))
    rows = sizes.select("k", "n", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    found = rows.groupBy("k", "n").agg(
        distinct.distinct_count(F.concat_ws("-", "k", "i"), approximate=True).alias("estimate")
    ).collect()
    errors = {r.n: abs(r.estimate - r.n) / r.n for r in found}
    assert all(e == 0 for n, e in errors.items() if n <= distinct.EXACT_BELOW)
    assert max(errors.values()) <= 4 * distinct.relative_error()
    assert max(errors) > 90_000


def test_nulls_and_no_rows(spark):
    table = spark.createDataFrame([(1, None), (1, "a"), (1, "a"), (2, None)], "k int, v string")
    for approximate in (False, True):
        counts = table.groupBy("k").agg(distinct.distinct_count(F.col("v"), approximate).alias("n"))
        assert {r.k: r.n for r in counts.collect()} == {1: 1, 2: 0}
        assert table.limit(0).agg(distinct.distinct_count(F.col("v"), approximate).alias("n")).first().n == 0


def test_sketched_share_needs_no_shuffle_by_value(spark):
    table = spark.range(5_000).select((F.col("id") / 2).cast("int").alias("v"))
    kwargs = {"column": "v", "min_value": 0.45, "max_value": 0.55, "approximate": True}
    check = {"expectation_type": quality.UNIQUE_SHARE, "kwargs": kwargs}
    results = quality.run_checks(table, "t", [check, quality.not_null("v")])
    assert "hashpartitioning" not in results._jdf.queryExecution().executedPlan().toString()
    first = results.where("check_no = 1").first()
    assert first.success and abs(first.observed_value - 0.5) < 0.02
    none = quality.run_checks(table.limit(0), "t", [check]).first()
    assert none.success and none.observed_value is None


MARTS = {
    "mart_category_performance": (models_sql.CATEGORY, "mart_category"),
    "mart_payment_behavior": (models_sql.PAYMENT, "mart_payment"),
    "mart_seller_performance": (models_sql.SELLER, "mart_seller"),
    "mart_rfm_segmentation": ("customer_unique_id i, total_orders i, total_spend d, f_score i, segment s", "mart_rfm"),
    "mart_customer_cohorts": (
        "customer_unique_id i, cohort_month t, total_orders i, repeat_within_30d i, is_repeat_customer i", "mart_cohorts"
    ),
}


@pytest.mark.parametrize("name", MARTS)
def test_marts_on_orders_given_twice(spark, name):
    """Every third order is delivered twice; ids are counted once."""
    columns, body = MARTS[name]
    once = Models(Marketplace(spark, FOLDER))
    twice = once.stg_orders.unionByName(once.stg_orders.where("order_id % 3 = 0"))
    models = Models(Marketplace(spark, FOLDER), stg_orders=twice)
    con = connect(FOLDER)
    con.execute(f"create table m_orders as select * from ({CTES['m_orders']})")
    con.execute("insert into m_orders select * from m_orders where order_id % 3 = 0")
    sql = query(f"select * from {body}", columns, given=("m_orders",))
    assert difference(portable(getattr(models, name), columns), con, sql) is None
