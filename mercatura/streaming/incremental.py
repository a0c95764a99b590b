"""The order upsert as a stream: files that arrive are merged batch by batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mercatura.operators.dedupe import first_per_key
from mercatura.operators.upsert import upsert_partitions
from mercatura.session import path_exists, stage

BATCH = "batch_id"


@dataclass(frozen=True)
class Late:
    """Rows whose ``ts`` is more than ``delay`` before the newest one of earlier batches are not merged
    but kept under ``path`` with the number of their batch."""

    ts: str
    delay: dt.timedelta
    path: str


def _keep(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write a partition of ``path``; a replayed batch replaces its own."""
    (
        rows.withColumn(BATCH, F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(path)
    )


def in_time(batch: DataFrame, batch_id: int, late: Late) -> DataFrame:
    """The rows of a batch that are not late; the late ones go to ``late.path``.

    The bound follows from what earlier batches have recorded, so a replayed batch is split as it was the
    first time. Rows without a time are never late. Recorded is one row per batch.
    """
    spark, times = batch.sparkSession, f"{late.path}/newest"
    bound = None
    if path_exists(spark, times):
        earlier = spark.read.schema(f"newest timestamp_ntz, {BATCH} bigint").parquet(times)
        newest = earlier.where(F.col(BATCH) < batch_id).agg(F.max("newest")).first()[0]
        bound = None if newest is None else newest - late.delay
    _keep(batch.agg(F.max(F.col(late.ts).cast("timestamp_ntz")).alias("newest")), times, batch_id)
    if bound is None:
        return batch
    is_late = F.coalesce(F.col(late.ts).cast("timestamp_ntz") < F.lit(bound).cast("timestamp_ntz"), F.lit(False))
    _keep(batch.where(is_late), f"{late.path}/rows", batch_id)
    return batch.where(~is_late)


def late_rows(spark: SparkSession, late: Late, like: DataFrame) -> DataFrame:
    """The late rows so far, with the columns of ``like`` and their batch."""
    schema = like.limit(0).withColumn(BATCH, F.lit(0).cast("bigint")).schema
    if not path_exists(spark, f"{late.path}/rows"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{late.path}/rows")


def merge_stream(
    source: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    newest_first: Sequence[Column],
    partition_columns: Sequence[str],
    late: Late | None = None,
) -> StreamingQuery:
    """Merge what a streaming ``source`` has into the partitioned table at ``path``.

    Of each key, the first row under ``newest_first`` among the stored one and all that
    arrive is kept, so neither the order of versions nor how files fall into micro-batches
    matters, and a replayed batch changes nothing. Without ``late`` no row is too late: one that
    arrives after years still fills a gap, or loses against the stored version. With it, very
    late rows are set apart and counted, so that they do not rewrite old partitions. No state is
    kept between batches but the tables.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        if late is not None:
            batch = in_time(stage(batch, "arrived"), batch_id, late)
        rows = first_per_key(batch, keys, newest_first)
        upsert_partitions(
            batch.sparkSession, path, rows, keys, partition_columns, newest_first=newest_first
        )

    return (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
