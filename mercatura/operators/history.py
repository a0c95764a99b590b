"""Slowly changing dimensions (type 2): apply a snapshot, current rows, as-of join."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from mercatura.functions.calendar import at
from mercatura.session import stage
from mercatura.sources import versions
from mercatura.sources.versions import Version

VALID_FROM, VALID_TO = "dbt_valid_from", "dbt_valid_to"


class SnapshotKeyError(ValueError):
    """A snapshot has rows without a key, or several with the same one."""


def require_snapshot_key(current: DataFrame, key: str) -> DataFrame:
    """``current`` if its key is filled and unique; such rows would multiply with every run."""
    per_key = current.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    bad = per_key.agg(
        F.sum(F.when(F.col(key).isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.count(F.when(F.col(key).isNotNull() & (F.col("n") > 1), 1)).alias("repeated"),
    ).first()
    if bad.nulls or bad.repeated:
        raise SnapshotKeyError(f"{key}: {bad.nulls} rows without it, {bad.repeated} keys repeated")
    return current


def first_snapshot(current: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Every row opens at the run time."""
    return current.select(
        "*",
        at(run_ts).alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )


def apply_snapshot(
    history: DataFrame,
    current: DataFrame,
    key: str,
    check_columns: Sequence[str],
    run_ts: dt.datetime,
) -> DataFrame:
    """The history after seeing ``current`` at ``run_ts``.

    A changed check column closes the open row and opens a new one, a new key
    opens a row, and a key that is gone stays open. Closed rows pass through;
    only open rows meet the snapshot, in one full outer join that emits one or
    two rows per key.
    """
    run = at(run_ts)
    columns = current.columns
    still_open = F.col(VALID_TO).isNull()
    old = history.where(still_open).select(key, F.struct(*columns, VALID_FROM).alias("_old"))
    new = current.select(key, F.struct(*columns).alias("_new"))

    def row(side: str, valid_from, valid_to):
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns],
            valid_from.alias(VALID_FROM),
            valid_to.cast("timestamp_ntz").alias(VALID_TO),
        )

    none = F.lit(None)
    since = F.col(f"_old.{VALID_FROM}")
    same = [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in check_columns]
    changed = ~same[0]
    for test in same[1:]:
        changed = changed | ~test
    rows = (
        F.when(F.col("_old").isNull(), F.array(row("_new", run, none)))
        .when(F.col("_new").isNull() | ~changed, F.array(row("_old", since, none)))
        .otherwise(F.array(row("_old", since, run), row("_new", run, none)))
    )
    merged = old.join(new, key, "full_outer").select(F.inline(rows))
    return history.where(~still_open).unionByName(merged)


CLOSED_AT = "closed_at"
"""Partition of a stored history: the run that closed a row, null for the open ones."""


def append_snapshot(
    spark: SparkSession,
    path: str,
    current: DataFrame,
    key: str,
    check_columns: Sequence[str],
    run_ts: dt.datetime,
) -> Version:
    """Bring the history stored at ``path`` up to ``current``; returns the version that holds it.

    Open rows lie in one partition and rows closed by a run in one of their own, so a run reads and
    writes the open rows only: what earlier runs closed stays in the files it is in, however long the
    history grows. A run that is repeated changes nothing.
    """
    base = versions.latest(spark, path)
    if base is None:
        opened = first_snapshot(current, run_ts).withColumn(CLOSED_AT, _closing_run())
        return versions.replace(opened, path, [CLOSED_AT], sort_key=key)
    run = Row(**{CLOSED_AT: run_ts.strftime("%Y-%m-%dT%H%M%S.%f")})
    mine = [versions.folder_of(Row(**{CLOSED_AT: None})), versions.folder_of(run)]
    history = versions.read(spark, path, versions.only(base, mine)).drop(CLOSED_AT)
    after = apply_snapshot(history, current, key, check_columns, run_ts).withColumn(CLOSED_AT, _closing_run())
    return versions.replace_partitions(after, path, base, [CLOSED_AT], mine)


def _closing_run() -> Column:
    return F.date_format(VALID_TO, "yyyy-MM-dd'T'HHmmss.SSSSSS")


def stored_history(spark: SparkSession, path: str, version: Version | int | None = None) -> DataFrame:
    """All versions of all keys of a stored history."""
    return versions.read(spark, path, version).drop(CLOSED_AT)


def with_current_flag(history: DataFrame) -> DataFrame:
    return history.withColumn("is_current", F.col(VALID_TO).isNull())


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col(VALID_TO).isNull())


# monotonically_increasing_id has the partition's number above the row's 33 bits.
_ROW_BITS = 33


def _version_starts(history: DataFrame, key: str, backdate: bool) -> DataFrame:
    """key, start and the other columns of each version; a backdated first version has no start."""
    others = F.struct(*[c for c in history.columns if c != key]).alias("version")
    versions = history.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(VALID_FROM).alias("start"), others
    )
    if not backdate:
        return versions
    first = F.min("start").over(Window.partitionBy("key"))
    return versions.withColumn("first", first).select(
        "key", F.when(F.col("start") > F.col("first"), F.col("start")).alias("start"), "version"
    )


def as_of_join(
    facts: DataFrame, history: DataFrame, key: str, ts: str, backdate: bool = False
) -> DataFrame:
    """Each fact with the version of ``key`` that was valid at ``ts``, nulls if none was.

    Versions and facts are sorted together by (key, time), by range, and a fact takes the last
    version before it. Facts of one key, even of one instant, spread over as many
    partitions as they need, as a hash of the fact is the end of the sort key. The last version of
    each partition is put before the first row of the next ones, and a window inside the
    partitions carries versions on. No fact meets a version it does not take, so a key of many facts and many
    versions costs their sum.

    The rows of ``facts`` stay what they are and as many as they are. Facts without a key or a time
    have no version; with ``backdate``, a key's first version also covers all time before it.
    Versions of one key must not overlap, and the columns besides the key have names of their own.
    """
    others = [c for c in history.columns if c != key]
    if clash := sorted(set(others) & set(facts.columns)):
        raise ValueError(f"columns in both facts and history: {clash}")
    versions = _version_starts(history, key, backdate)
    # The key and the time of a fact travel once, as what it is sorted by, unless other types come of the union.
    sorted_by, kinds = {key: "key", ts: "start"}, dict(facts.dtypes)
    known = all(kinds.get(c) == dict(versions.dtypes)[s] for c, s in sorted_by.items())
    carried_columns = [c for c in facts.columns if not (known and c in sorted_by)] or facts.columns
    taken = facts.select(
        F.col(key).alias("key"),
        F.col(ts).alias("start"),
        F.struct(*[F.col(f"`{c}`") for c in carried_columns]).alias("fact"),
    )

    def of_fact(column: str) -> Column:
        return F.col("fact").getField(column) if column in carried_columns else F.col(sorted_by[column])

    both = versions.unionByName(taken, allowMissingColumns=True)
    both = both.withColumn("is_fact", F.col("fact").isNotNull())
    order = [F.col("key"), F.col("start").asc_nulls_first(), "is_fact", F.xxhash64("fact")]
    placed = stage(both.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "as-of")
    placed = placed.withColumn("part", F.shiftright("place", _ROW_BITS))

    version_place = F.when(~F.col("is_fact"), F.col("place"))
    tails = placed.groupBy("part").agg(F.max_by(F.struct("key", "version"), version_place).alias("tail"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition of the sort, so this window has at most spark.sql.shuffle.partitions rows.
    carried = stage(tails.select("part", F.last("tail", ignorenulls=True).over(earlier).alias("tail")), "carried")
    brought = carried.where("tail is not null").select(
        F.col("tail.key").alias("key"),
        F.col("tail.version").alias("version"),
        F.lit(False).alias("is_fact"),
        (F.shiftleft("part", _ROW_BITS) - 1).alias("place"),  # before the partition's first row
        "part",
    )
    carrying = placed.unionByName(brought, allowMissingColumns=True)
    so_far = Window.partitionBy("part", "key").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    found = carrying.withColumn("version", F.last("version", ignorenulls=True).over(so_far)).where("is_fact")
    ended = F.col("start") < F.col(f"version.{VALID_TO}")
    valid = F.col("start").isNotNull() & (F.col(f"version.{VALID_TO}").isNull() | ended)
    return found.select(
        *[of_fact(c).alias(c) for c in facts.columns],
        *[F.when(valid, F.col("version").getField(c)).alias(c) for c in others],
    )
