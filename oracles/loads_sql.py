"""Ingest, incremental merge, history and streaming, over data derived from the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.functions.calendar import at
from mercatura.operators import history, upsert
from mercatura.plans import marts
from mercatura.plans.daily import increment
from mercatura.plans.models import Models
from mercatura.session import stage, staged_path
from mercatura.sources import raw_csv, tables, versions
from mercatura.sources.contracts import CONTRACTS
from mercatura.sources.marketplace import RawTables
from mercatura.sources.seeds import load_translation
from mercatura.streaming.incremental import Late, in_time, late_rows, merge_stream
from oracles.duck import key
from oracles.models_sql import CATEGORY, STG_ITEMS, STG_ORDERS, STG_REVIEWS
from oracles.entries import register

FORMAT = "yyyy-MM-dd HH:mm:ss"

# ── Raw files ────────────────────────────────────────────────────────────────


def as_text(df: DataFrame) -> DataFrame:
    """Every column the way a CSV export holds it."""
    return df.select(
        *[
            (F.date_format(c, FORMAT) if kind.startswith("timestamp") else F.col(c).cast("string"))
            .alias(c)
            for c, kind in df.dtypes
        ]
    )


def short_states(df: DataFrame) -> DataFrame:
    """State names cut to the eight characters of the contract, from the right to stay apart."""
    return df.withColumns({c: F.right(c, F.lit(8)) for c in df.columns if c.endswith("_state")})


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, quote='"', escape='"')


def raw_orders(m: Models) -> DataFrame:
    """Orders as text; every 97th approval and every 89th purchase time is unreadable."""
    order = F.col("order_id").cast("bigint")
    return as_text(m.raw.orders).withColumns(
        {
            "order_approved_at": F.when(order % 97 == 0, "soon").otherwise(
                F.col("order_approved_at")
            ),
            "order_purchase_timestamp": F.when(order % 89 == 0, "n/a").otherwise(
                F.col("order_purchase_timestamp")
            ),
        }
    )


def _text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


RAW_ORDERS = f"""(
  select order_id, customer_id, order_status,
         case when order_id % 89 = 0 then 'n/a' else {_text('order_purchase_timestamp')} end
           as order_purchase_timestamp,
         case when order_id % 97 = 0 then 'soon' else {_text('order_approved_at')} end
           as order_approved_at,
         {_text('order_delivered_carrier_date')} as order_delivered_carrier_date,
         {_text('order_delivered_customer_date')} as order_delivered_customer_date,
         {_text('order_estimated_delivery_date')} as order_estimated_delivery_date
  from m_orders)"""


def csv_scan(m: Models) -> DataFrame:
    path = staged_path(m.raw.spark, "csv")
    write_csv(as_text(m.raw.reviews), path)
    return raw_csv.require_rows(raw_csv.read_csv(m.raw.spark, path, multiline=True), "reviews")


register(
    "ing_csv_scan",
    "review_id s, order_id s, review_score s, review_comment_title s, "
    "review_comment_message s, review_creation_date s, review_answer_timestamp s",
    csv_scan,
    f"""select review_id, order_id, review_score, comment_title as review_comment_title,
       comment_message as review_comment_message,
       {_text('review_creation_date')} as review_creation_date,
       {_text('review_answer_timestamp')} as review_answer_timestamp
from m_raw_reviews""",
)


def split_quotes(m: Models) -> DataFrame:
    """Reviews in one file, with line breaks, quotes and separators in their messages, read by many tasks."""
    spark, path = m.raw.spark, staged_path(m.raw.spark, "quoted")
    message = F.col("review_comment_message")
    broken = as_text(m.raw.reviews).withColumn(
        "review_comment_message",
        F.when(F.col("review_id") % 3 == 0, F.concat(message, F.lit('\nsaid "no",\n\n'), message)).otherwise(message),
    )
    write_csv(broken.coalesce(1), path)
    return raw_csv.read_files(spark, path, multiline=True, split_above=0, block_bytes=50_000).drop(raw_csv.MALFORMED)


register(
    "ing_split_quotes",
    "review_id s, order_id s, review_score s, review_comment_title s, "
    "review_comment_message s, review_creation_date s, review_answer_timestamp s",
    split_quotes,
    f"""select review_id, order_id, review_score, comment_title as review_comment_title,
       case when review_id % 3 = 0
            then comment_message || chr(10) || 'said "no",' || chr(10) || chr(10) || comment_message
            else comment_message end as review_comment_message,
       {_text('review_creation_date')} as review_creation_date,
       {_text('review_answer_timestamp')} as review_answer_timestamp
from m_raw_reviews""",
)


def schema_drift(m: Models) -> DataFrame:
    """Two deliveries: the earlier one has no approval column."""
    spark, orders = m.raw.spark, raw_orders(m)
    early, late = staged_path(spark, "early"), staged_path(spark, "late")
    is_early = F.coalesce(F.col("order_estimated_delivery_date") < "1998-01-01", F.lit(False))
    write_csv(orders.where(is_early).drop("order_approved_at"), early)
    write_csv(orders.where(~is_early), late)
    return raw_csv.merge_drift([raw_csv.read_csv(spark, p) for p in (late, early)])


ORDERS_TEXT = (
    "order_id s, customer_id s, order_status s, order_purchase_timestamp s, "
    "order_approved_at s, order_delivered_carrier_date s, order_delivered_customer_date s, "
    "order_estimated_delivery_date s"
)
register(
    "ing_schema_drift",
    ORDERS_TEXT,
    schema_drift,
    f"""select * replace (case when order_estimated_delivery_date >= '1998-01-01'
                    then order_approved_at end as order_approved_at)
from {RAW_ORDERS}""",
)


def repaired_columns(m: Models) -> DataFrame:
    """Approval times split over a plain and a typed column, the id only typed."""
    order = F.col("order_id").cast("bigint")
    split = raw_orders(m).select(
        order.alias("order_id_long"),
        F.when(order % 3 == 0, F.col("order_approved_at")).alias("order_approved_at"),
        F.when(order % 3 != 0, F.col("order_approved_at")).alias("order_approved_at_string"),
        *[c for c in CONTRACTS["orders"].columns if c not in ("order_id", "order_approved_at")],
    )
    return raw_csv.repair_columns(split, CONTRACTS["orders"])


register("ing_repair_columns", ORDERS_TEXT, repaired_columns, f"select * from {RAW_ORDERS}")


def without_empty_columns(m: Models) -> DataFrame:
    reviews = m.raw.reviews.withColumn("review_comment_title", F.lit(None).cast("string"))
    left, dropped = raw_csv.drop_all_null(reviews)
    return left.select(
        "review_id", "order_id", "review_score", F.lit(",".join(dropped)).alias("dropped_columns")
    )


register(
    "ing_drop_all_null",
    "review_id i, order_id i, review_score i, dropped_columns s",
    without_empty_columns,
    "select *, 'review_comment_title' as dropped_columns from m_raw_reviews",
)


def partition_counts(m: Models) -> DataFrame:
    parted = raw_csv.add_partition_columns(raw_orders(m), "order_purchase_timestamp")
    return parted.groupBy("partition_year", "partition_month").agg(
        F.count(F.lit(1)).alias("row_count")
    )


register(
    "ing_partition_columns",
    "partition_year s, partition_month s, row_count i",
    partition_counts,
    f"""select left(good, 4) as partition_year, substr(good, 6, 2) as partition_month,
       count(*) as row_count
from (select nullif(order_purchase_timestamp, 'n/a') as good from {RAW_ORDERS}) group by 1, 2""",
)

register(
    "ing_timestamp_failures",
    "column_name s, unparsed_rows i",
    lambda m: raw_csv.timestamp_failures(raw_orders(m), CONTRACTS["orders"].timestamps),
    " union all ".join(
        f"select '{c}' as column_name, count(case when {c} in ('soon', 'n/a') then 1 end) "
        f"as unparsed_rows from {RAW_ORDERS}"
        for c in CONTRACTS["orders"].timestamps
    ),
)


def processed_orders(m: Models) -> str:
    spark = m.raw.spark
    raw, processed = staged_path(spark, "raw"), staged_path(spark, "processed")
    write_csv(raw_orders(m), raw)
    tables.csv_to_parquet(spark, raw, processed, CONTRACTS["orders"])
    return processed


def one_month(m: Models) -> DataFrame:
    return tables.read_partitions(m.raw.spark, processed_orders(m), "1998", "08")


register(
    "ing_partition_read",
    ORDERS_TEXT,
    one_month,
    f"select * from {RAW_ORDERS} where order_purchase_timestamp like '1998-08-%'",
)


def loaded_orders(m: Models) -> DataFrame:
    target = staged_path(m.raw.spark, "target")
    tables.reload_table(m.raw.spark, processed_orders(m), target, CONTRACTS["orders"])
    return tables.read_table(m.raw.spark, target)


register(
    "ing_contract_orders",
    "order_id s, customer_id s, order_status s, order_purchase_timestamp t, "
    "order_approved_at t, order_delivered_carrier_date t, order_delivered_customer_date t, "
    "order_estimated_delivery_date t",
    loaded_orders,
    """select * replace (
         case when order_id % 89 <> 0 then order_purchase_timestamp end
           as order_purchase_timestamp,
         case when order_id % 97 <> 0 then order_approved_at end as order_approved_at)
from m_orders""",
)


def load_everything(m: Models) -> DataFrame:
    spark = m.raw.spark
    raw, processed, target = (staged_path(spark, f) for f in ("raw", "processed", "target"))
    for name in CONTRACTS:
        write_csv(as_text(short_states(getattr(m.raw, name))), f"{raw}/{name}")
    return tables.load_all(spark, raw, processed, target)


_LOADED = {
    "orders": "m_orders",
    "customers": "m_customers",
    "order_items": "m_items",
    "payments": "m_payments",
    "reviews": "m_raw_reviews",
    "products": "m_raw_products",
    "sellers": "m_sellers",
    "geolocation": "customer",
}
register(
    "ing_load_summary",
    "table_name s, rows i, status s",
    load_everything,
    " union all ".join(
        f"select '{name}' as table_name, count(*) as rows, 'loaded' as status from {source}"
        for name, source in _LOADED.items()
    )
    + " union all select 'category_translation', 5, 'loaded'",
)



def mixed_headers(m: Models) -> DataFrame:
    """Three deliveries in one folder: other order, a column less, a column more."""
    spark, orders = m.raw.spark, raw_orders(m)
    raw, processed, target = (staged_path(spark, f) for f in ("raw", "processed", "target"))
    share = F.col("order_id").cast("bigint") % 3
    deliveries = [
        orders.where(share == 0),
        orders.where(share == 1).select(*reversed(orders.columns)),
        orders.where(share == 2).drop("order_approved_at").withColumn("channel", F.lit("web")),
    ]
    for part in deliveries:
        part.write.csv(f"{raw}/orders", header=True, quote='"', escape='"', mode="append")
    contracts = {"orders": CONTRACTS["orders"]}
    tables.load_all(spark, raw, processed, target, contracts).collect()
    return tables.read_table(spark, f"{target}/orders")


register(
    "ing_mixed_headers",
    "order_id s, customer_id s, order_status s, order_purchase_timestamp t, "
    "order_approved_at t, order_delivered_carrier_date t, order_delivered_customer_date t, "
    "order_estimated_delivery_date t",
    mixed_headers,
    """select * replace (
         case when order_id % 89 <> 0 then order_purchase_timestamp end
           as order_purchase_timestamp,
         case when order_id % 97 <> 0 and order_id % 3 <> 2 then order_approved_at end
           as order_approved_at)
from m_orders""",
)


def malformed_rows(m: Models) -> DataFrame:
    """Sellers as lines of text: every 7th lacks its last field, every 11th has one too many."""
    spark = m.raw.spark
    raw, processed, target = (staged_path(spark, f) for f in ("raw", "processed", "target"))
    sellers = as_text(short_states(m.raw.sellers))
    ident = F.col("seller_id").cast("bigint")
    names = sellers.columns
    line = (
        F.when(ident % 7 == 0, F.concat_ws(",", *names[:-1]))
        .when(ident % 11 == 0, F.concat_ws(",", *names, F.lit("more")))
        .otherwise(F.concat_ws(",", *names))
    )
    # One task and file: the header line comes first.
    head = spark.createDataFrame([(0, ",".join(names))], "place bigint, line string")
    lines = head.unionByName(sellers.select((ident + 1).alias("place"), line.alias("line")))
    lines.coalesce(1).sortWithinPartitions("place").select("line").write.text(f"{raw}/sellers")
    contracts = {"sellers": CONTRACTS["sellers"]}
    return tables.load_all(spark, raw, processed, target, contracts, allow_malformed=1 << 40)


register(
    "ing_malformed_rows",
    "table_name s, rows i, malformed i, status s",
    malformed_rows,
    """select 'sellers' as table_name, count(*) as rows,
       count(case when seller_id % 7 = 0 or seller_id % 11 = 0 then 1 end) as malformed,
       'loaded' as status
from m_sellers""",
)


def seeded_products(m: Models) -> DataFrame:
    """Products per English category, translated by the seed as loaded from its file."""
    path = staged_path(m.raw.spark, "seed")
    write_csv(m.raw.category_translation, path)
    raw = RawTables(
        **{name: getattr(m.raw, name) for name in CONTRACTS if name != "category_translation"},
        category_translation=load_translation(m.raw.spark, path),
    )
    english = F.col("category_name_en").alias("category_name_english")
    products = Models(raw).stg_products.groupBy(english)
    return products.agg(F.count(F.lit(1)).alias("product_count"))


register(
    "ing_seed",
    "category_name_english s, product_count i",
    seeded_products,
    "select category_name_en as category_name_english, count(*) as product_count "
    "from m_products group by all",
)


def contract_violations(m: Models) -> DataFrame:
    """Every 6th order has no id, every 10th a status that is too long."""
    order = F.col("order_id").cast("bigint")
    broken = raw_orders(m).withColumns(
        {
            "order_id": F.when(order % 6 != 0, F.col("order_id")),
            "order_status": F.when(order % 10 == 0, F.repeat("order_status", 9)).otherwise(
                F.col("order_status")
            ),
        }
    )
    found = raw_csv.contract_violations(broken, CONTRACTS["orders"])
    return found.where("row_count > 0")


register(
    "ing_contract_violations",
    "violation s, row_count i",
    contract_violations,
    """select 'order_id is null' as violation, count(*) as row_count from m_orders
where order_id % 6 = 0 having count(*) > 0
union all
select 'order_status is longer than 32', count(*) from m_orders
where order_id % 10 = 0 and length(order_status) * 9 > 32 having count(*) > 0""",
)


def numeric_variants(m: Models) -> DataFrame:
    """Photo counts that arrive as doubles, longs or text."""
    photos = F.col("product_photos_qty")
    part = F.col("product_id").cast("bigint") % 3
    split = m.raw.products.select(
        "product_id",
        F.when(part == 0, photos.cast("double")).alias("product_photos_qty_double"),
        F.when(part == 1, photos.cast("bigint")).alias("product_photos_qty_long"),
        F.when(part == 2, photos.cast("string")).alias("product_photos_qty"),
    )
    repaired = raw_csv.repair_columns(split, CONTRACTS["products"])
    others = [c for c in CONTRACTS["products"].columns if c not in repaired.columns]
    typed = raw_csv.apply_contract(repaired, CONTRACTS["products"], others)
    return typed.select("product_id", "product_photos_qty")


register(
    "ing_numeric_variants",
    "product_id s, product_photos_qty i",
    numeric_variants,
    "select product_id, photos_qty as product_photos_qty from m_raw_products",
)

# ── Incremental merge ────────────────────────────────────────────────────────

CUT = "2000-01-01"


def _cut() -> dt.datetime:
    return dt.datetime.fromisoformat(CUT)


def first_orders(m: Models) -> DataFrame:
    """The table after a first run at the cut: the last ten days are not final."""
    placed = F.col("order_purchase_timestamp")
    early = m.stg_orders.where(placed <= at(_cut()))
    stale = placed > at(_cut() - dt.timedelta(days=10))
    return early.withColumn(
        "order_status", F.when(stale, "processing").otherwise(F.col("order_status"))
    )


def order_batch(m: Models, target: DataFrame) -> DataFrame:
    return upsert.recent(m.stg_orders, target, "order_purchase_timestamp")


def upserted_orders(m: Models) -> DataFrame:
    target = first_orders(m)
    return upsert.upsert(target, order_batch(m, target), ["order_key"])


# Stale rows keep 'processing' unless the three days before the newest cover them.
UPSERTED_ORDERS = f"""select o.* replace (
    case when order_purchase_timestamp <= timestamp '{CUT}'
          and order_purchase_timestamp > timestamp '{CUT}' - interval 10 days
          and order_purchase_timestamp < newest - interval 3 days
         then 'processing' else order_status end as order_status),
    {key('order_id')} as order_key
from m_orders o, (select max(order_purchase_timestamp) as newest from m_orders
                  where order_purchase_timestamp <= timestamp '{CUT}') n"""
register("upsert_orders", STG_ORDERS, upserted_orders, UPSERTED_ORDERS)

register(
    "upsert_order_changes",
    "action s, row_count i",
    lambda m: upsert.changes(first_orders(m), order_batch(m, first_orders(m)), ["order_key"]),
    f"""select case when order_purchase_timestamp > timestamp '{CUT}' then 'inserted'
            when order_purchase_timestamp < newest - interval 3 days then 'untouched'
            when order_status <> 'processing' then 'updated' else 'unchanged' end as action,
       count(*) as row_count
from m_orders, (select max(order_purchase_timestamp) as newest from m_orders
                where order_purchase_timestamp <= timestamp '{CUT}')
group by 1""",
)


def by_month(df: DataFrame) -> DataFrame:
    return df.withColumn("purchase_month", F.date_format("order_purchase_timestamp", "yyyy-MM"))


def upserted_partitions(m: Models) -> DataFrame:
    spark, path = m.raw.spark, staged_path(m.raw.spark, "orders")
    first = by_month(first_orders(m))
    upsert.upsert_partitions(spark, path, first, ["order_key"], ["purchase_month"])
    target = spark.read.schema(first.schema).parquet(path)
    batch = by_month(order_batch(m, target))
    upsert.upsert_partitions(spark, path, batch, ["order_key"], ["purchase_month"])
    return spark.read.schema(first.schema).parquet(path)


register(
    "upsert_order_partitions",
    STG_ORDERS + ", purchase_month s",
    upserted_partitions,
    f"select *, strftime(order_purchase_timestamp, '%Y-%m') as purchase_month "
    f"from ({UPSERTED_ORDERS})",
)


def changed_rows(m: Models) -> DataFrame:
    target = first_orders(m)
    found = upsert.change_rows(target, order_batch(m, target), ["order_key"])
    path = staged_path(m.raw.spark, "feed")
    for _ in range(2):  # a batch sent again is kept once
        upsert.append_changes(found, path, "batch 1")
    kept = m.raw.spark.read.parquet(path)
    return kept.select(
        "order_key", "action", "batch_id", "before.order_status", F.col("after.order_status").alias("new_status")
    )


register(
    "upsert_change_rows",
    "order_key s, action s, batch_id s, order_status s, new_status s",
    changed_rows,
    f"""select {key('order_id')} as order_key, 'batch 1' as batch_id, order_status as new_status,
       case when order_purchase_timestamp > timestamp '{CUT}' then 'inserted' else 'updated' end as action,
       case when order_purchase_timestamp <= timestamp '{CUT}' then 'processing' end as order_status
from m_orders, (select max(order_purchase_timestamp) as newest from m_orders
                where order_purchase_timestamp <= timestamp '{CUT}')
where order_purchase_timestamp > timestamp '{CUT}'
   or (order_purchase_timestamp >= newest - interval 3 days and order_status <> 'processing')""",
)


def refreshed_category(m: Models) -> DataFrame:
    """A mart of yesterday's orders, brought up to date from the changes of a small batch."""
    order = F.col("order_id")
    late, stale = order % 4999 == 4, order % 4999 == 3
    before = m.stg_orders.where(~late).withColumn(
        "order_status", F.when(stale, "processing").otherwise(F.col("order_status"))
    )
    # Read three times: the latest copies of lines and reviews are found once.
    items = m.stg_order_items.select("order_id", "product_id", "price", "freight_value")
    reviews = m.stg_reviews.select("order_id", "review_id", "review_score", "review_creation_date")
    items, reviews = stage(items, "items"), stage(reviews, "reviews")
    given = (items, m.stg_products, reviews)
    old = stage(marts.mart_category_performance(before, *given), "mart")
    batch = m.stg_orders.where(late | stale)
    feed = stage(upsert.change_rows(before, batch, ["order_id"]), "feed")
    touched = stage(marts.touched_categories(feed, items, m.stg_products), "touched")
    after = upsert.upsert(before, batch, ["order_id"])
    return marts.refresh_category_performance(old, touched, after, *given)


register(
    "mart_category_refresh", CATEGORY, refreshed_category, "select * from mart_category"
)


def versioned_orders(m: Models) -> DataFrame:
    """Both versions of a table, the first one read after the second was made."""
    spark, path = m.raw.spark, staged_path(m.raw.spark, "versions")
    old = upsert.upsert_version(spark, path, by_month(first_orders(m)), ["order_key"], ["purchase_month"])
    batch = by_month(order_batch(m, versions.read(spark, path, old)))
    new = upsert.upsert_version(spark, path, batch, ["order_key"], ["purchase_month"])
    return versions.read(spark, path, old.number).withColumn("version", F.lit(1)).unionByName(
        versions.read(spark, path, new.number).withColumn("version", F.lit(2))
    )


register(
    "upsert_version_read",
    STG_ORDERS + ", purchase_month s, version i",
    versioned_orders,
    f"""select *, strftime(order_purchase_timestamp, '%Y-%m') as purchase_month
from (select *, 2 as version from ({UPSERTED_ORDERS})
union all
select o.* replace (case when order_purchase_timestamp > timestamp '{CUT}' - interval 10 days
                         then 'processing' else order_status end as order_status),
       {key('order_id')} as order_key, 1 as version
from m_orders o where order_purchase_timestamp <= timestamp '{CUT}')""",
)


def moved_orders(m: Models) -> DataFrame:
    """Corrected purchase times move some orders to another month; an index of keys finds their old copies."""
    spark, path = m.raw.spark, staged_path(m.raw.spark, "moved")
    by_key = (["order_key"], ["purchase_month"])
    placed = F.col("order_purchase_timestamp")
    kept = m.stg_orders.where(placed.isNotNull())
    upsert.upsert_version(spark, path, by_month(kept), *by_key, indexed=True)
    for digit, days in ((3, 40), (5, -400)):
        moved = kept.where((F.col("order_id") % 1000 == digit) & (placed > at(_cut())))
        moved = moved.withColumn("order_purchase_timestamp", placed + F.make_dt_interval(F.lit(days)))
        upsert.upsert_version(spark, path, by_month(moved), *by_key, indexed=True)
    return versions.read(spark, path)


register(
    "upsert_moved_keys",
    STG_ORDERS + ", purchase_month s",
    moved_orders,
    f"""select *, strftime(order_purchase_timestamp, '%Y-%m') as purchase_month
from (select * replace (
          case when order_purchase_timestamp <= timestamp '{CUT}' then order_purchase_timestamp
               when order_id::bigint % 1000 = 3 then order_purchase_timestamp + interval 40 days
               when order_id::bigint % 1000 = 5 then order_purchase_timestamp - interval 400 days
               else order_purchase_timestamp end as order_purchase_timestamp),
          {key('order_id')} as order_key
      from m_orders where order_purchase_timestamp is not null)""",
)


def upserted_items(m: Models) -> DataFrame:
    """First run without the newest items and with a wrong price on all others."""
    ts = F.col("shipping_limit_date")
    target = m.stg_order_items.where(ts <= at(_cut())).withColumn(
        "price", F.lit(0).cast("decimal(10,2)")
    )
    batch = upsert.recent(m.stg_order_items, target, "shipping_limit_date")
    return upsert.upsert(target, batch, ["order_id", "order_item_id"])


register(
    "upsert_order_items",
    STG_ITEMS,
    upserted_items,
    f"""select i.*, {key('order_id', 'order_item_id')} as order_item_key,
       case when shipping_limit_date >= newest - interval 3 days then price_c / 1e2
            else 0 end as price,
       freight_c / 1e2 as freight_value
from m_items i, (select max(shipping_limit_date) as newest from m_items
                 where shipping_limit_date <= timestamp '{CUT}')""",
)

REVIEW_CUT = "2024-01-20"


def upserted_reviews(m: Models) -> DataFrame:
    created = F.col("review_creation_date")
    cut = at(dt.datetime.fromisoformat(REVIEW_CUT))
    target = m.stg_reviews.where(created <= cut).withColumn("review_score", F.lit(0))
    batch = increment(m, "stg_reviews", target, "review_creation_date")
    return upsert.upsert(target, batch, ["review_key"])


register(
    "upsert_reviews",
    STG_REVIEWS,
    upserted_reviews,
    f"""select r.* replace (case when review_creation_date >= newest - interval 3 days
                    then review_score else 0 end as review_score),
       {key('review_id', 'order_id')} as review_key
from m_reviews r, (select max(review_creation_date) as newest from m_reviews
                   where review_creation_date <= timestamp '{REVIEW_CUT}')""",
)

# ── History ──────────────────────────────────────────────────────────────────

RUNS = (dt.datetime(1995, 1, 1), dt.datetime(1998, 1, 1))
CUSTOMER_CHECKS = ["zip_code_prefix", "customer_city", "customer_state"]
SELLER_CHECKS = ["zip_code_prefix", "seller_city", "seller_state"]


def customer_snapshots(m: Models) -> tuple[DataFrame, DataFrame]:
    """Two snapshots: some customers are new in the second, some gone, some moved."""
    customers = m.stg_customers.drop("customer_key")
    ident = F.col("customer_id")
    moved = customers.where(ident % 13 != 0).withColumn(
        "customer_city",
        F.when(ident % 5 == 0, F.concat("customer_city", F.lit(" north")))
        .when(ident % 7 == 0, F.lit(None))
        .otherwise(F.col("customer_city")),
    )
    return customers.where(ident % 11 != 0), moved


def customer_history(m: Models) -> DataFrame:
    first, moved = customer_snapshots(m)
    opened = history.first_snapshot(first, RUNS[0])
    return history.apply_snapshot(opened, moved, "customer_id", CUSTOMER_CHECKS, RUNS[1])


def seller_history(m: Models) -> DataFrame:
    sellers = m.stg_sellers.drop("seller_key")
    ident = F.col("seller_id")
    first = history.first_snapshot(sellers.where(ident % 11 != 0), RUNS[0])
    moved = sellers.where(ident % 13 != 0).withColumn(
        "seller_state", F.when(ident % 5 == 0, "ELSEWHERE").otherwise(F.col("seller_state"))
    )
    return history.apply_snapshot(first, moved, "seller_id", SELLER_CHECKS, RUNS[1])


def _history(source: str, ident: str, column: str, moved: str, changes: str) -> str:
    """The versions stated case by case: old, then new."""
    run1, run2 = (f"timestamp '{r:%Y-%m-%d}'" for r in RUNS)
    seen_first, seen_second = f"{ident} % 11 <> 0", f"{ident} % 13 <> 0"
    closed = f"{seen_second} and ({changes})"
    return f"""(
  select *, {run1} as dbt_valid_from, case when {closed} then {run2} end as dbt_valid_to
  from {source} where {seen_first}
  union all by name
  select * replace ({moved} as {column}), {run2} as dbt_valid_from,
         cast(null as timestamp) as dbt_valid_to
  from {source} where {seen_second} and (not ({seen_first}) or ({changes})))"""


CUSTOMER_HISTORY = _history(
    "m_customers",
    "customer_id",
    "customer_city",
    "case when customer_id % 5 = 0 then customer_city || ' north' "
    "when customer_id % 7 = 0 then null else customer_city end",
    "customer_id % 5 = 0 or customer_id % 7 = 0",
)
SELLER_HISTORY = _history(
    "m_sellers",
    "seller_id",
    "seller_state",
    "case when seller_id % 5 = 0 then 'ELSEWHERE' else seller_state end",
    "seller_id % 5 = 0",
)

SCD_CUSTOMERS = (
    "customer_id i, customer_unique_id i, zip_code_prefix s, customer_city s, "
    "customer_state s, dbt_valid_from t, dbt_valid_to t"
)
SCD_SELLERS = (
    "seller_id i, zip_code_prefix s, seller_city s, seller_state s, "
    "dbt_valid_from t, dbt_valid_to t"
)
register("scd2_customers", SCD_CUSTOMERS, customer_history, f"select * from {CUSTOMER_HISTORY}")
register("scd2_sellers", SCD_SELLERS, seller_history, f"select * from {SELLER_HISTORY}")


def appended_history(m: Models) -> DataFrame:
    """The customers' history as a stored table after three runs, the last one without a change."""
    spark, path = m.raw.spark, staged_path(m.raw.spark, "history")
    customers, moved = customer_snapshots(m)
    for current, run in ((customers, RUNS[0]), (moved, RUNS[1]), (moved, dt.datetime(1999, 1, 1))):
        history.append_snapshot(spark, path, current, "customer_id", CUSTOMER_CHECKS, run)
    return history.stored_history(spark, path)


register("scd2_append", SCD_CUSTOMERS, appended_history, f"select * from {CUSTOMER_HISTORY}")
register(
    "scd2_current_sellers",
    SCD_SELLERS,
    lambda m: history.current_rows(seller_history(m)),
    f"select * from {SELLER_HISTORY} where dbt_valid_to is null",
)


def items_with_seller_then(m: Models) -> DataFrame:
    items = m.stg_order_items.join(
        m.stg_orders.select("order_id", "order_purchase_timestamp"), "order_id", "left"
    )
    versions = seller_history(m).select("seller_id", "seller_state", *_PERIOD)
    return history.as_of_join(items, versions, "seller_id", "order_purchase_timestamp")


_PERIOD = (history.VALID_FROM, history.VALID_TO)
register(
    "scd2_as_of_items",
    "order_id i, order_item_id i, seller_id i, order_purchase_timestamp t, seller_state s, "
    "dbt_valid_from t",
    items_with_seller_then,
    f"""select i.order_id, i.order_item_id, i.seller_id, o.order_purchase_timestamp,
       h.seller_state, h.dbt_valid_from
from m_items i left join m_orders o on i.order_id = o.order_id
left join {SELLER_HISTORY} h on i.seller_id = h.seller_id
  and o.order_purchase_timestamp >= h.dbt_valid_from
  and (h.dbt_valid_to is null or o.order_purchase_timestamp < h.dbt_valid_to)""",
)

# ── Streaming ────────────────────────────────────────────────────────────────


def streamed_orders(m: Models) -> DataFrame:
    """Orders that arrive as files, each delivered in two versions, merged into a table."""
    spark = m.raw.spark
    inbox, table, marks = (staged_path(spark, f) for f in ("inbox", "table", "marks"))
    final = by_month(m.stg_orders)
    final.withColumn("order_approved_at", F.lit(None).cast("timestamp_ntz")).withColumn(
        "order_status", F.lit("created")
    ).unionByName(final).write.parquet(inbox)
    newest_first = [
        F.col("order_approved_at").desc_nulls_last(),
        (F.col("order_status") == "created").asc(),
    ]
    merge_stream(
        spark.readStream.schema(final.schema).parquet(inbox),
        table,
        marks,
        keys=["order_key"],
        newest_first=newest_first,
        partition_columns=["purchase_month"],
    ).awaitTermination()
    return spark.read.schema(final.schema).parquet(table)


register(
    "stream_upsert_orders",
    STG_ORDERS + ", purchase_month s",
    streamed_orders,
    f"select *, {key('order_id')} as order_key, "
    "strftime(order_purchase_timestamp, '%Y-%m') as purchase_month from m_orders",
)


LATE_DELAY = dt.timedelta(days=180)


def streamed_late_rows(m: Models) -> DataFrame:
    """Three micro-batches: orders until 1998 as created, later ones with final states for the last months of 1998,
    then all final states again, most of them too late by then."""
    spark = m.raw.spark
    inbox, table, marks, side = (staged_path(spark, f) for f in ("inbox", "table", "marks", "late"))
    final, placed = by_month(m.stg_orders), F.col("order_purchase_timestamp")
    first = final.where(placed < "1999-01-01").withColumn("order_status", F.lit("created"))
    late = Late("order_purchase_timestamp", LATE_DELAY, side)
    for arriving in (first, final.where(placed >= "1998-09-01"), final):
        arriving.write.mode("append").parquet(inbox)
        merge_stream(
            spark.readStream.schema(final.schema).parquet(inbox),
            table,
            marks,
            keys=["order_key"],
            newest_first=[(F.col("order_status") == "created").asc()],
            partition_columns=["purchase_month"],
            late=late,
        ).awaitTermination()
    # The third batch once more, as after a failure before it was committed.
    in_time(final, 2, late)
    merged = spark.read.schema(final.schema).parquet(table).withColumn("batch_id", F.lit(None).cast("bigint"))
    return merged.unionByName(late_rows(spark, late, final))


register(
    "stream_late_rows",
    "order_id i, order_status s, order_purchase_timestamp t, purchase_month s, batch_id d",
    streamed_late_rows,
    """select order_id, order_purchase_timestamp, strftime(order_purchase_timestamp, '%Y-%m') as purchase_month,
       case when order_purchase_timestamp < timestamp '1998-09-01'
                 and order_purchase_timestamp < newest - interval 180 days
            then 'created' else order_status end as order_status, null as batch_id
from m_orders, (select max(order_purchase_timestamp) as newest from m_orders)
union all
select order_id, order_purchase_timestamp, strftime(order_purchase_timestamp, '%Y-%m'), order_status, 2
from m_orders, (select max(order_purchase_timestamp) as newest from m_orders)
where order_purchase_timestamp < newest - interval 180 days""",
)
