"""Physical plans, with broadcasts by size switched off as on large tables."""

import re

import pytest

from pyspark.sql import functions as F

from mercatura.plans.models import Models
from mercatura.sources.marketplace import Marketplace
from oracles.registry import REGISTRY

FOLDER = "/root/testdata/sf0.001"
LAZY = [
    name
    for name in REGISTRY
    if name.startswith(("stg_", "int_", "fact_", "dim_", "scd2_"))
    or name in ("mart_category_performance", "mart_customer_cohorts", "mart_payment_behavior")
]


@pytest.fixture
def large(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df, executed=False):
    if executed:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_single_task_and_no_all_pairs(large, name):
    plan = _plan(REGISTRY[name].run(large, FOLDER))
    assert "CartesianProduct" not in plan and "Broadcast" not in plan
    if name != "dim_date":  # bounds of the calendar: a global minimum and maximum
        assert "SinglePartition" not in plan


@pytest.mark.parametrize("name", ["mart_rfm_segmentation", "mart_seller_performance"])
def test_ranks_put_only_partition_sizes_into_one_task(large, name):
    plan = _plan(REGISTRY[name].run(large, FOLDER))
    assert "ntile" not in plan
    for part in re.findall(r"Exchange SinglePartition.*\n.*\n", plan):
        assert "_size" in part


def test_latest_rows_are_cut_before_the_shuffle(large):
    plan = _plan(REGISTRY["stg_reviews"].run(large, FOLDER))
    exchange = plan.index("Exchange hashpartitioning")
    assert "Final" in plan[:exchange] and "WindowGroupLimit" in plan[exchange:]


def test_sequence_numbers_come_from_sorted_places(large):
    plan = _plan(Models(Marketplace(large, FOLDER)).int_customer_enriched, executed=True)
    assert "sum(_size" in plan and "_at" in plan  # sums of runs; no window over a key's rows


def test_orders_enriched_shuffles_each_input_by_order_once(large):
    plan = _plan(REGISTRY["int_orders_enriched"].run(large, FOLDER))
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#", plan)) == 2
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey#", plan)) == 1


def test_scans_read_only_what_a_mart_needs(large):
    plan = _plan(REGISTRY["mart_payment_behavior"].run(large, FOLDER))
    for scan in re.findall(r"FileScan parquet \[([^\]]*)\].*?lineitem", plan):
        columns = {c.split("#")[0] for c in scan.split(",")}
        assert columns == {"l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag"}
    assert "props" not in _plan(REGISTRY["mart_delivery_analysis"].run(large, FOLDER))


def test_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    orders = Models(Marketplace(spark, FOLDER)).stg_orders.where(
        "order_id = 7 and order_purchase_timestamp >= timestamp_ntz '2000-01-01'"
    )
    plan = _plan(orders)
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "EqualTo(o_orderkey,7)" in pushed and "GreaterThanOrEqual(o_orderdate" in pushed


def test_funnel_reads_orders_once(spark):
    plan = _plan(REGISTRY["anl_order_funnel"].run(spark, FOLDER))
    assert plan.count("FileScan") == 1 and "Expand" not in plan


@pytest.fixture
def small_skew(large):
    """Partitions count as skewed from a few kilobytes on, as they would from 256 MB."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: large.conf.get(key) for key in settings}
    for key, value in settings.items():
        large.conf.set(key, value)
    yield large
    for key, value in before.items():
        large.conf.set(key, value)


def _hot_items(spark):
    """Items of which a third belong to one order, one product and one seller."""
    items = spark.range(0, 60000, 1, 8)
    hot = F.col("id") % 3 == 0
    return items.select(
        F.when(hot, 7).otherwise(F.col("id") % 1500).cast("bigint").alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        F.md5(F.col("id").cast("string")).alias("order_item_key"),
        F.when(hot, 7).otherwise(F.col("id") % 200).cast("bigint").alias("product_id"),
        F.when(hot, 7).otherwise(F.col("id") % 10).cast("bigint").alias("seller_id"),
        F.lit(None).cast("timestamp_ntz").alias("shipping_limit_date"),
        F.lit(10).cast("decimal(10,2)").alias("price"),
        # No two alike: equal rows would compress to a partition that is not large.
        (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 100).cast("decimal(10,2)").alias("freight_value"),
    )


@pytest.mark.parametrize(
    "model",
    ["int_order_items_enriched", "int_delivery_analysis", "mart_delivery_analysis"],
)
def test_hot_keys_of_fact_joins_are_split(small_skew, model):
    items = _hot_items(small_skew)
    models = Models(Marketplace(small_skew, FOLDER), stg_order_items=items)
    plan = _plan(getattr(models, model), executed=True).split("Initial Plan")[0]
    assert "skew=true" in plan


def test_hot_items_are_combined_before_the_order_join(large):
    models = Models(Marketplace(large, FOLDER), stg_order_items=_hot_items(large))
    plan = _plan(models.mart_category_performance)
    join = plan.index("SortMergeJoin [order_id#")
    assert "HashAggregate(keys=[order_id#" in plan[join:]
