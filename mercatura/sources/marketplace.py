"""The nine raw marketplace tables, expressed over the benchmark's Parquet tables.

Each property is a lazy projection, so a model reads only the columns it uses.
Any object with the same nine attributes can stand in for this class; see
``RawTables``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercatura.operators.dedupe import first_per_key

# The columns read from each source table. Declared, so that no job
# has to look into file footers before a query is planned.
SOURCE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}

# Category names with a translation. PROMO has none on purpose.
TRANSLATED_TYPES = ("STANDARD", "SMALL", "LARGE", "ECONOMY", "MEDIUM")


@dataclass(frozen=True)
class RawTables:
    """Raw tables from anywhere: a warehouse, CSV files, a test."""

    orders: DataFrame
    customers: DataFrame
    order_items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    products: DataFrame
    sellers: DataFrame
    geolocation: DataFrame
    category_translation: DataFrame


# Order status by source status and first character of the priority.
ORDER_STATUS = """
    case when o_orderstatus = 'O' then
           case left(o_orderpriority, 1)
             when '1' then 'shipped' when '2' then 'invoiced' when '3' then 'processing'
             when '4' then 'approved' else 'created' end
         when o_orderstatus = 'P' and o_orderpriority like '1%' then 'canceled'
         when o_orderstatus = 'P' and o_orderpriority like '2%' then 'unavailable'
         else 'delivered' end
"""

# Payment type by return flag, in the order of the sequence number.
PAYMENT_SLOTS = {
    "credit_card": "l_returnflag = 'A'",
    "voucher": "l_returnflag = 'N'",
    "boleto": "l_returnflag = 'R'",
    "not_defined": "l_returnflag is null or l_returnflag not in ('A', 'N', 'R')",
}


class Marketplace:
    """Raw tables derived from a folder with the benchmark's Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return (
            self.source("orders")
            .selectExpr(
                "o_orderkey as order_id",
                "o_orderkey as customer_id",
                f"{ORDER_STATUS} as order_status",
                "o_orderdate as placed",
            )
            .selectExpr(
                "order_id",
                "customer_id",
                "order_status",
                "placed as order_purchase_timestamp",
                "case when order_status not in ('created', 'canceled') "
                "then placed + interval 1 day end as order_approved_at",
                "case when order_status in ('shipped', 'delivered') "
                "then placed + interval 3 days end as order_delivered_carrier_date",
                "case when order_status = 'delivered' and order_id % 53 <> 0 "
                "then placed + make_dt_interval(cast(5 + order_id % 37 as int)) end "
                "as order_delivered_customer_date",
                "placed + interval 25 days as order_estimated_delivery_date",
            )
        )

    def _nations(self) -> DataFrame:
        return self.source("nation").selectExpr("n_nationkey as nation", "n_name as state")

    @cached_property
    def customers(self) -> DataFrame:
        people = (
            self.source("customer")
            .selectExpr("c_custkey as o_custkey", "c_nationkey as nation")
            .join(self._nations(), "nation", "left")
        )
        placed = self.source("orders").select("o_orderkey", "o_custkey")
        return placed.join(people, "o_custkey", "left").selectExpr(
            "o_orderkey as customer_id",
            "o_custkey as customer_unique_id",
            "cast(nation as string) as customer_zip_code_prefix",
            "state || ' city' as customer_city",
            "state as customer_state",
        )

    @cached_property
    def order_items(self) -> DataFrame:
        """The latest copy of every line: (order, line number) occurs more than once."""
        lines = self.source("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "l_extendedprice",
            "l_tax",
            "l_shipdate",
        )
        latest = [
            F.col("l_shipdate").desc_nulls_last(),
            F.col("l_partkey").asc_nulls_last(),
            F.col("l_suppkey").asc_nulls_last(),
            F.col("l_extendedprice").asc_nulls_last(),
            F.col("l_tax").asc_nulls_last(),
        ]
        return first_per_key(lines, ["l_orderkey", "l_linenumber"], latest).selectExpr(
            "l_orderkey as order_id",
            "l_linenumber as order_item_id",
            "l_partkey as product_id",
            "l_suppkey as seller_id",
            "l_shipdate as shipping_limit_date",
            "cast(l_extendedprice as decimal(10,2)) as price",
            "cast(cast(l_extendedprice as decimal(10,2)) * cast(l_tax as decimal(4,2)) "
            "as decimal(10,2)) as freight_value",
        )

    @cached_property
    def payments(self) -> DataFrame:
        """One payment per order and return flag.

        The flags are a closed set, so one aggregation by order carries all of
        them and the sequence number is the position in the array: a single
        shuffle, combined on the map side, and no window. Values are added up in
        whole cents: sums of longs update in place in the aggregation map.
        """
        cents = "cast(cast(l_extendedprice as decimal(10,2)) * 100 as bigint)"
        measures = []
        for name, here in PAYMENT_SLOTS.items():
            measures += [
                F.expr(f"max(case when {here} then l_quantity end) as {name}_quantity"),
                F.expr(f"sum(case when {here} then {cents} end) as {name}_cents"),
                F.expr(f"count(case when {here} then 1 end) as {name}_lines"),
            ]
        slots = ", ".join(
            f"""case when {name}_lines > 0 then named_struct(
                  'payment_type', '{name}',
                  'payment_installments', cast({name}_quantity as int) % 15,
                  'payment_value',
                    cast(cast({name}_cents as decimal(19,0)) * 0.01 as decimal(10,2))) end"""
            for name in PAYMENT_SLOTS
        )
        return (
            self.source("lineitem")
            .groupBy("l_orderkey")
            .agg(*measures)
            .selectExpr(
                "l_orderkey as order_id",
                f"posexplode(array_compact(array({slots}))) as (place, payment)",
            )
            .selectExpr("order_id", "place + 1 as payment_sequential", "payment.*")
        )

    @cached_property
    def reviews(self) -> DataFrame:
        return self.source("events").selectExpr(
            "case when event_id % 20 = 0 then event_id + 1 else event_id end as review_id",
            "event_id - event_id % 2 as order_id",
            "cast(floor(value) as int) % 5 + 1 as review_score",
            "event_type as review_comment_title",
            "props as review_comment_message",
            "ts as review_creation_date",
            "case when event_id % 7 <> 0 then ts + interval 1 day end as review_answer_timestamp",
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.source("part").selectExpr(
            "p_partkey as product_id",
            "case when p_size % 25 <> 0 then p_type end as product_category_name",
            "length(p_name) as product_name_lenght",
            "length(p_name) + length(p_brand) as product_description_lenght",
            "p_size % 6 as product_photos_qty",
            "cast(p_size as decimal(10,2)) as product_weight_g",
            "cast(p_size % 7 + 1 as decimal(10,2)) as product_length_cm",
            "cast(p_size % 11 + 1 as decimal(10,2)) as product_height_cm",
            "cast(p_size % 13 + 1 as decimal(10,2)) as product_width_cm",
        )

    @cached_property
    def sellers(self) -> DataFrame:
        suppliers = self.source("supplier").selectExpr("s_suppkey", "s_nationkey as nation")
        return suppliers.join(self._nations(), "nation", "left").selectExpr(
            "s_suppkey as seller_id",
            "cast(nation as string) as seller_zip_code_prefix",
            "state || ' city' as seller_city",
            "state as seller_state",
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        people = self.source("customer").selectExpr(
            "c_nationkey as nation",
            "cast(cast(c_acctbal as decimal(18,2)) / 10000 as decimal(18,15)) as degrees",
        )
        return people.join(self._nations(), "nation", "left").selectExpr(
            "cast(nation as string) as geolocation_zip_code_prefix",
            "degrees as geolocation_lat",
            "cast(-degrees as decimal(18,15)) as geolocation_lng",
            "state || ' city' as geolocation_city",
            "state as geolocation_state",
        )

    @cached_property
    def category_translation(self) -> DataFrame:
        # As literals: Spark sees the size and broadcasts it, where it would take
        # rows that come from Python for a table of unknown size.
        names = ", ".join(f"'{name}'" for name in TRANSLATED_TYPES)
        return (
            self.spark.range(1)
            .selectExpr(f"explode(array({names})) as product_category_name")
            .selectExpr(
                "product_category_name",
                "lower(product_category_name) as product_category_name_english",
            )
        )
