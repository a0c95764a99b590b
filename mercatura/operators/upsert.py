"""Incremental merge by key with a lookback for late rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from mercatura.operators.dedupe import first_per_key
from mercatura.session import drop_path, path_exists, stage
from mercatura.sources import key_index, versions
from mercatura.sources.versions import Version


def recent(source: DataFrame, target: DataFrame, ts: str, lookback_days: int = 3) -> DataFrame:
    """Rows of ``source`` no older than the newest target row minus the lookback.

    An empty target has no newest row, so the first run takes everything. Rows without
    a time are always taken: nothing tells that they are old. The bound is a scalar
    subquery: it is computed once and filters the scan.
    """
    newest = target.agg(F.max(ts).alias("newest")).scalar()
    bound = newest - F.make_dt_interval(F.lit(lookback_days))
    late = F.col(ts).cast("timestamp_ntz") < bound
    return source.where(newest.isNull() | F.col(ts).isNull() | ~late)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch.

    The batch has one row per key. Keys compare null-safe, so a row without a key replaces the stored
    one without, and a batch that is merged again changes nothing.
    """
    return _by_key(target, batch, keys, "left_anti").unionByName(batch)


def _by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Target rows that have (left_semi) or have not (left_anti) a batch row of their key."""
    named = batch.select(*[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)])
    same = [target[k].eqNullSafe(named[f"_of_{i}"]) for i, k in enumerate(keys)]
    return target.join(named, reduce(lambda a, b: a & b, same), how)


def change_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What merging ``batch`` changes: the keys, action, and the row before and after.

    The action is 'inserted', with no row before, or 'updated'. Batch rows that repeat the stored one
    are no change and do not appear. Keys compare null-safe, as in the merge.
    """
    compared = [c for c in batch.columns if c not in keys]
    old = target.select(
        *[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)], F.struct(*compared).alias("before")
    )
    new = batch.select(*keys, F.struct(*compared).alias("after"))
    same = reduce(lambda a, b: a & b, [new[k].eqNullSafe(old[f"_of_{i}"]) for i, k in enumerate(keys)])
    met = new.join(old, same, "left").where(~F.col("before").eqNullSafe(F.col("after")))
    action = F.when(F.col("before").isNull(), "inserted").otherwise("updated")
    return met.select(*keys, action.alias("action"), "before", "after")


def append_changes(rows: DataFrame, path: str, batch_id: str) -> None:
    """Keep the changes of one batch in the feed at ``path``, a partition per batch.

    A batch that is sent again replaces its own partition, so the feed has each change once.
    """
    (
        rows.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def changes(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many batch rows insert, update or repeat a target row; what is untouched."""
    compared = [c for c in batch.columns if c not in keys]
    old = target.select(*keys, F.struct(*compared).alias("_old"))
    new = batch.select(*keys, F.struct(*compared).alias("_new"))
    action = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col("_new").isNull(), "untouched")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged")
        .otherwise("updated")
    )
    return (
        old.join(new, list(keys), "full_outer")
        .groupBy(action.alias("action"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def upsert_partitions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_columns: Sequence[str],
    keys_move: bool = True,
    newest_first: Sequence[Column] = (),
) -> None:
    """Merge ``batch`` into the partitioned Parquet table at ``path``.

    A batch row replaces the stored row of its key; with ``newest_first``, only if it
    comes before the stored one in that order.

    Only partitions that hold a batch row, or an older copy of one, are read in
    full and written again; finding the older copies reads nothing but the keys,
    and ``keys_move=False`` skips it where a key never changes its partition. The
    merged partitions are staged before any file of the table is replaced, and Spark
    replaces files only when all of them are written, so until that last step a lost
    executor or a failed write leaves the table as it was. Rows are rebalanced by partition,
    which keeps the number of files near that of the partitions.
    """
    if not path_exists(spark, path):
        by_partition = batch.hint("rebalance", *partition_columns)
        by_partition.write.partitionBy(*partition_columns).parquet(path)
        return
    batch = stage(batch, "batch")
    # With the batch's schema, folder names such as '08' stay text.
    target = spark.read.schema(batch.schema).parquet(path)
    if newest_first:
        batch = _newest(target, batch, keys, newest_first)
    touched = _touched(target, batch, keys, partition_columns, keys_move)
    if not touched:
        return
    merged = stage(upsert(target.where(_in_partitions(touched)), batch, keys), "merged")
    (
        merged.hint("rebalance", *partition_columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_columns)
        .parquet(path)
    )
    filled = set(merged.select(*partition_columns).distinct().collect())
    for row in touched:
        if row not in filled:  # its last row moved to another partition
            drop_path(spark, _partition_path(path, row))


def _newest(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]
) -> DataFrame:
    """One row per key of the batch: the first of the stored and the new ones."""
    stored = _by_key(target, batch, keys, "left_semi")
    return stage(first_per_key(stored.unionByName(batch), keys, newest_first), "batch")


def _touched(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    partition_columns: Sequence[str],
    keys_move: bool,
) -> list[Row]:
    """The partitions that hold a batch row or an older copy of one: at most one row per folder."""
    places = batch.select(*partition_columns)
    if keys_move:
        older = _by_key(target, batch, keys, "left_semi")
        places = places.unionByName(older.select(*partition_columns))
    return places.distinct().collect()


def upsert_version(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_columns: Sequence[str],
    keys_move: bool = True,
    newest_first: Sequence[Column] = (),
    indexed: bool = False,
) -> Version:
    """Merge ``batch`` into the versioned table at ``path``; returns the version that holds it.

    The rules are those of ``upsert_partitions``. The touched partitions are written beside the old ones
    and the next version names them instead, all at once: readers go on with the version they have,
    and a writer that dies at any step leaves the newest one as it was. Rows are written
    once, as nothing that is read is replaced.

    With ``indexed``, every write gets an index of its keys (``sources.key_index``), and older copies are looked
    for in the partitions that the index names, not in the keys of all.
    """
    base = versions.latest(spark, path)
    if base is None:
        made = versions.replace(batch, path, partition_columns)
    else:
        made = _merged(spark, path, base, batch, keys, partition_columns, keys_move, newest_first, indexed)
    if indexed:
        key_index.build(spark, path, made, keys, partition_columns)
    return made


def _merged(
    spark: SparkSession,
    path: str,
    base: Version,
    batch: DataFrame,
    keys: Sequence[str],
    partition_columns: Sequence[str],
    keys_move: bool,
    newest_first: Sequence[Column],
    indexed: bool,
) -> Version:
    batch, searched = stage(batch, "batch"), base
    if indexed and (keys_move or newest_first):
        searched = key_index.candidates(spark, path, base, batch, keys, partition_columns)
    target = versions.read(spark, path, searched)
    if newest_first:
        batch = _newest(target, batch, keys, newest_first)
    touched = _touched(target, batch, keys, partition_columns, keys_move)
    if not touched:
        return base
    folders = [versions.folder_of(row) for row in touched]
    old = versions.read(spark, path, versions.only(base, folders))
    return versions.replace_partitions(upsert(old, batch, keys), path, base, partition_columns, folders)


def _in_partitions(rows: Sequence[Row]) -> Column:
    """Whether a row lies in one of the partitions; flat lists of values, however many."""
    by_rest: dict[tuple, list] = {}
    for row in rows:
        *rest, last = row
        by_rest.setdefault(tuple(rest), []).append(last)
    *others, name = rows[0].asDict()
    tests = []
    for rest, values in by_rest.items():
        test = F.col(name).isin([v for v in values if v is not None])
        if None in values:
            test = F.coalesce(test, F.lit(False)) | F.col(name).isNull()
        for column, value in zip(others, rest):
            test = test & F.col(column).eqNullSafe(F.lit(value))
        tests.append(test)
    return reduce(lambda a, b: a | b, tests)


def _partition_path(path: str, row: Row) -> str:
    parts = (
        f"{c}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
        for c, value in row.asDict().items()
    )
    return "/".join([path, *parts])
