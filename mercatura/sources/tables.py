"""Writing tables, reloading them in full, and checking what arrived."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercatura.session import aside, drop_path, path_exists, publish
from mercatura.sources.contracts import CONTRACTS, Contract
from mercatura.sources.raw_csv import (
    MALFORMED,
    PARTITION_COLUMNS,
    add_partition_columns,
    apply_contract,
    drop_partition_columns,
    observed_timestamps,
    observed_violations,
    read_files,
    repair_columns,
    require_rows,
)

logger = logging.getLogger(__name__)


class RowCountMismatch(RuntimeError):
    """The target does not hold as many rows as were sent."""


class MalformedRows(RuntimeError):
    """Files hold rows that do not fit their header."""


class ContractBroken(RuntimeError):
    """Rows break the contract of their table."""


class LoadFailed(RuntimeError):
    """At least one table of a run failed; ``summary`` tells which."""

    def __init__(self, summary: DataFrame, failed: Sequence[str]):
        super().__init__(f"load failed for {', '.join(failed)}")
        self.summary = summary


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_key: str | None = None,
    check: Callable[[int], None] | None = None,
) -> int:
    """Replace the table at ``path`` with Snappy Parquet; returns the rows written.

    The rows go to a folder beside it, which takes its place when it is whole and
    ``check``, given the rows written, has not raised: until then readers see the old
    table. The count is observed during the write, without a pass of its own. With
    partition columns, rows are first rebalanced by them: each partition is
    written by few tasks, and one that holds most rows is split over several.
    """
    spark = df.sparkSession
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_key:
        # Narrow min/max per row group, so scans on the key skip most of a file.
        df = df.sortWithinPartitions(*partition_by, sort_key)
    seen = Observation()
    made = f"{path}.new-{uuid.uuid4().hex}"
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.option("compression", "snappy").parquet(made)
        rows = seen.get["rows"]
        if check is not None:
            check(rows)
    except Exception:
        drop_path(spark, made)
        raise
    publish(spark, made, path)
    return rows


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table; fails when it has no rows.

    Between the two renames of a writer, or after one that died there, this is the old table where it
    stepped aside; a reader never moves it.
    """
    here = path if path_exists(spark, path) or not path_exists(spark, aside(path)) else aside(path)
    return require_rows(spark.read.parquet(here), path)


def read_partitions(spark: SparkSession, path: str, year: str, month: str) -> DataFrame:
    """One month of a partitioned table; no other folder is listed or read."""
    # Spark reads folder names such as '08' as numbers.
    wanted = (F.col("partition_year") == int(year)) & (F.col("partition_month") == int(month))
    return spark.read.parquet(path).where(wanted)


class Processed(NamedTuple):
    """What ``csv_to_parquet`` wrote, the all-null columns it left out, and malformed rows."""

    rows: int
    all_null: list[str]
    malformed: int = 0


def csv_to_parquet(
    spark: SparkSession, source: str, target: str, contract: Contract, allow_malformed: int = 0
) -> Processed:
    """Raw files to processed Parquet: repair, drop empty columns, partition by month.

    The files are parsed once: values per column and malformed rows are counted while the
    rows are written. Only when a column turns out to be empty are the rows, as
    Parquet much cheaper to read than the files, written again without it. More than
    ``allow_malformed`` malformed rows stop the load before the target is replaced.
    """
    read = require_rows(read_files(spark, source, contract.multiline), source)
    # Counted before any column is left out, so the parser sees all fields.
    faults = Observation()
    read = read.observe(faults, F.count(F.col(MALFORMED)).alias("malformed"))
    df = repair_columns(read.drop(MALFORMED), contract)
    columns, parts = df.columns, ()
    if contract.partition_by:
        df, parts = add_partition_columns(df, contract.partition_by), PARTITION_COLUMNS
    values = Observation()
    counted = df.observe(values, *[F.count(F.col(c)).alias(c) for c in df.columns])
    found: dict[str, int] = {}

    def check(_: int) -> None:
        found["malformed"] = faults.get["malformed"]
        if found["malformed"] > allow_malformed:
            raise MalformedRows(f"{source}: {found['malformed']} rows do not fit their header")

    rows = write_table(counted, target, parts, check=check)
    empty = [c for c in columns if values.get[c] == 0]
    if empty:
        logger.warning("%s: all-null columns dropped: %s", source, empty)
        rows = write_table(spark.read.schema(df.schema).parquet(target).drop(*empty), target, parts)
    if contract.partition_by and contract.partition_by in columns:
        unread = values.get[contract.partition_by] - values.get["partition_year"]
        if unread:
            logger.warning("%s: %s dates cannot be read", source, unread)
    return Processed(rows, empty, found["malformed"])


def reload_table(
    spark: SparkSession,
    source: str,
    target: str,
    contract: Contract,
    all_null: Sequence[str] = (),
) -> int:
    """Processed Parquet to the raw layer: typed, in contract order, replaced in full.

    Returns the rows written after checking that the target holds as many. Nulls in
    the required column and values too long for theirs stop the load before the target is
    replaced.
    """
    processed = drop_partition_columns(repair_columns(read_table(spark, source), contract))
    cast, seen = observed_timestamps(processed, contract.timestamps)
    typed = apply_contract(cast, contract, all_null)
    guarded, broken = observed_violations(typed, contract)

    def check(_: int) -> None:
        found = {rule: n for rule, n in broken.get.items() if n} if contract.has_rules else {}
        if found:
            told = "; ".join(f"{rule}: {n} rows" for rule, n in found.items())
            raise ContractBroken(f"{target}: {told}")

    rows = write_table(guarded, target, sort_key=contract.sort_key, check=check)
    for name, count in seen.get.items():
        if name != "rows" and count:
            logger.warning("%s: %s: %s values are no timestamps", target, name, count)
    reconcile(rows, spark.read.parquet(target), target)
    return rows


def reconcile(source_rows: int, target: DataFrame, name: str) -> int:
    """The target's row count (answered from Parquet footers), or an error."""
    target_rows = target.count()
    if target_rows != source_rows:
        raise RowCountMismatch(f"{name}: {source_rows} rows sent, {target_rows} arrived")
    return target_rows


def run_tables(
    spark: SparkSession, load: Callable[[str], int | tuple[int, int]], names: Sequence[str], parallel: int = 3
) -> DataFrame:
    """Load every table; one failure does not stop the others.

    ``load`` returns the rows it loaded, or these and the malformed rows among them.
    Returns (table_name, rows, status, error, malformed). Raises ``LoadFailed`` with that
    summary at the end when a table failed. Small tables run side by side, so
    the cluster is not idle between their jobs.
    """

    def one(name: str) -> tuple:
        try:
            loaded = load(name)
            rows, malformed = loaded if isinstance(loaded, tuple) else (loaded, 0)
            return name, rows, "loaded", None, malformed
        except Exception as error:  # reported per table, raised at the end
            logger.exception("%s failed", name)
            return name, None, "failed", f"{type(error).__name__}: {error}", None

    with ThreadPoolExecutor(parallel) as pool:
        results = list(pool.map(one, names))
    summary = spark.createDataFrame(
        results, "table_name string, rows bigint, status string, error string, malformed bigint"
    )
    failed = [name for name, _, status, *_ in results if status == "failed"]
    if failed:
        raise LoadFailed(summary, failed)
    return summary


def load_all(
    spark: SparkSession,
    raw: str,
    processed: str,
    target: str,
    contracts: Mapping[str, Contract] = CONTRACTS,
    allow_malformed: int = 0,
) -> DataFrame:
    """Both steps for every table under three root folders."""

    def load(name: str) -> tuple[int, int]:
        contract, between = contracts[name], f"{processed}/{name}"
        step = csv_to_parquet(spark, f"{raw}/{name}", between, contract, allow_malformed)
        rows = reload_table(spark, between, f"{target}/{name}", contract, step.all_null)
        return rows, step.malformed

    return run_tables(spark, load, list(contracts))


def read_all(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The loaded tables by name: ``RawTables(**read_all(spark, folder))``."""
    return {name: spark.read.parquet(f"{target}/{name}") for name in CONTRACTS}
