"""One run from raw files to tested marts, in the order the layers depend on each other."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercatura.operators.history import append_snapshot, require_snapshot_key, stored_history
from mercatura.operators.quality import append_failures, check_freshness, failures, require_passed
from mercatura.operators.upsert import recent, upsert_version
from mercatura.plans import staging, suites
from mercatura.plans.models import Models
from mercatura.plans.testing import check_models, run_suite
from mercatura.session import drop_staged
from mercatura.sources import key_index, versions
from mercatura.sources.contracts import CONTRACTS, Contract
from mercatura.sources.marketplace import RawTables
from mercatura.sources.raw_csv import apply_contract, cast_timestamps
from mercatura.sources.tables import (
    csv_to_parquet,
    read_all,
    read_table,
    reload_table,
    run_tables,
    write_table,
)

# Fixed values. Incremental staging models: merge keys and the column the lookback goes by.
INCREMENTAL = {
    "stg_orders": (["order_key"], "order_purchase_timestamp"),
    "stg_order_items": (["order_id", "order_item_id"], "shipping_limit_date"),
    "stg_reviews": (["review_key"], "review_creation_date"),
}

KEPT_VERSIONS = 3
"""Versions of a stored model that readers may still be pinned to."""

# Fixed values. Snapshots: staging model, business key and checked columns.
SNAPSHOTS = {
    "customers": ("stg_customers", "customer_id", ["customer_city", "customer_state"]),
    "sellers": ("stg_sellers", "seller_id", ["seller_city", "seller_state"]),
}


def typed(processed: DataFrame, contract: Contract, all_null: Sequence[str] = ()) -> DataFrame:
    """Processed text columns in the contract's types, before anything is loaded."""
    return apply_contract(cast_timestamps(processed, contract.timestamps), contract, all_null)


def gate(tables: Mapping[str, DataFrame], suite, run_ts: dt.datetime, audit: str) -> DataFrame:
    """Run the suites; record failures under ``audit`` and stop when there are any."""
    return enforce(run_suite(suite, tables), run_ts, audit)


def freshness(raw: RawTables, now: dt.datetime) -> DataFrame:
    ages = [
        check_freshness(getattr(raw, name), name, column, now, warn, error)
        for name, (column, warn, error) in suites.FRESHNESS.items()
    ]
    return reduce(DataFrame.unionByName, ages)


def increment(models: Models, name: str, stored: DataFrame, ts: str) -> DataFrame:
    """What is new of a staging model. Raw reviews are filtered before they are deduplicated, so
    that a copy inside the lookback counts even where an older copy would win."""
    if name == "stg_reviews":
        return staging.stg_reviews(recent(models.raw.reviews, stored, ts))
    return recent(getattr(models, name), stored, ts)


def update_staging(spark: SparkSession, models: Models, folder: str) -> dict[str, DataFrame]:
    """Merge what is new into the stored incremental models; returns them."""
    stored = {}
    for name, (keys, ts) in INCREMENTAL.items():
        path, batch = f"{folder}/{name}", getattr(models, name)
        if versions.latest(spark, path) is not None:
            batch = increment(models, name, versions.read(spark, path), ts)
        by_month = batch.withColumn("partition_month", F.date_format(ts, "yyyy-MM"))
        made = upsert_version(spark, path, by_month, keys, ["partition_month"], indexed=True)
        stored[name] = versions.read(spark, path, made).drop("partition_month")
        versions.expire(spark, path, KEPT_VERSIONS)
        key_index.expire(spark, path)
    return stored


def update_snapshots(
    spark: SparkSession, models: Models, folder: str, run_ts: dt.datetime
) -> dict[str, DataFrame]:
    """Bring the stored histories up to ``run_ts``; returns them."""
    stored = {}
    for name, (model, key, checks) in SNAPSHOTS.items():
        path = f"{folder}/{name}"
        current = getattr(models, model).drop("customer_key", "seller_key")
        current = require_snapshot_key(current, key)
        made = append_snapshot(spark, path, current, key, ["zip_code_prefix", *checks], run_ts)
        stored[name] = stored_history(spark, path, made)
        versions.expire(spark, path, KEPT_VERSIONS)
    return stored


def build_marts(spark: SparkSession, models: Models, folder: str) -> dict[str, DataFrame]:
    """Write every mart and return the stored tables."""

    def write(name: str) -> int:
        return write_table(getattr(models, name), f"{folder}/{name}")

    run_tables(spark, write, list(suites.MART_TESTS))
    return {name: spark.read.parquet(f"{folder}/{name}") for name in suites.MART_TESTS}


def daily_run(
    spark: SparkSession,
    raw_files: str,
    warehouse: str,
    run_ts: dt.datetime,
    suite: Mapping[str, Sequence[dict]] = suites.SUITES,
) -> DataFrame:
    """Ingest, gate, reload, staging, snapshots, marts, tests.

    A failed check of the gate stops the run before the raw layer is replaced. At the
    end, the tests of seeds, staging, intermediate models and marts are run, failures
    are recorded, and any of them fails the run. Returns the results.
    """
    try:
        return _daily_run(spark, raw_files, warehouse, run_ts, suite)
    finally:
        drop_staged(spark)


def _daily_run(
    spark: SparkSession,
    raw_files: str,
    warehouse: str,
    run_ts: dt.datetime,
    suite: Mapping[str, Sequence[dict]],
) -> DataFrame:
    processed, raw = f"{warehouse}/processed", f"{warehouse}/raw"
    all_null: dict[str, list[str]] = {}

    def ingest(name: str) -> int:
        step = csv_to_parquet(
            spark, f"{raw_files}/{name}", f"{processed}/{name}", CONTRACTS[name]
        )
        all_null[name] = step.all_null
        return step.rows

    def reload(name: str) -> int:
        source, target = f"{processed}/{name}", f"{raw}/{name}"
        return reload_table(spark, source, target, CONTRACTS[name], all_null[name])

    run_tables(spark, ingest, list(CONTRACTS))
    arrived = {
        name: typed(read_table(spark, f"{processed}/{name}"), CONTRACTS[name], all_null[name])
        for name in suite
    }
    gate(arrived, suite, run_ts, f"{warehouse}/audit")
    run_tables(spark, reload, list(CONTRACTS))

    tables = RawTables(**read_all(spark, raw))
    stale = freshness(tables, run_ts).where("status = 'error'").collect()  # one row per table
    if stale:
        raise RuntimeError(f"sources are too old: {', '.join(r.table_name for r in stale)}")
    computed = Models(tables)
    stored = update_staging(spark, computed, f"{warehouse}/staging")
    update_snapshots(spark, computed, f"{warehouse}/snapshots", run_ts)
    marts = build_marts(spark, Models(tables, **stored), f"{warehouse}/marts")
    tested = check_all(Models(tables, **stored), tables, marts)
    return enforce(tested, run_ts, f"{warehouse}/audit")


def check_all(models: Models, raw: RawTables, marts: Mapping[str, DataFrame]) -> DataFrame:
    """The results of all model tests; stored tables are tested where they are."""
    seeds = run_suite(suites.SEED_TESTS, {n: getattr(raw, n) for n in suites.SEED_TESTS})
    parents = {"stg_customers": models.stg_customers, "stg_sellers": models.stg_sellers}
    return reduce(
        DataFrame.unionByName,
        [
            seeds,
            check_models(models, suites.STAGING_TESTS),
            check_models(models, suites.INTERMEDIATE_TESTS, parents),
            run_suite(suites.MART_TESTS, marts),
        ],
    )


def enforce(results: DataFrame, run_ts: dt.datetime, audit: str) -> DataFrame:
    """Record failed checks under ``audit`` and raise; the results, off the staged tables, if
    all passed."""
    spark = results.sparkSession
    kept = results.collect()  # one row per check
    results = spark.createDataFrame(kept, results.schema)
    failed = failures(results, run_ts)
    if not failed.isEmpty():
        append_failures(failed, audit)
    require_passed(results)
    return results
