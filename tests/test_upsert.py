"""Incremental merge: lookback, idempotence, partition-wise rewrite."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mercatura.operators import upsert
from mercatura.session import staged_path

SCHEMA = "id int, ts timestamp_ntz, status string"


def _day(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def target(spark):
    rows = [(1, _day(0), "old"), (2, _day(7), "old"), (3, _day(8), "old"), (4, _day(10), "old")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def source(spark):
    rows = [(i, _day(d), "new") for i, d in ((1, 0), (2, 7), (3, 8), (4, 10), (5, 11))]
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted((r.id, r.status) for r in df.collect())


def test_lookback_takes_the_boundary_and_leaves_older_rows(source, target):
    # Newest is day 10: day 7 is exactly three days back, day 0 is outside.
    assert [r.id for r in upsert.recent(source, target, "ts").orderBy("id").collect()] == [
        2, 3, 4, 5,
    ]


def test_first_run_takes_everything(source, target):
    assert upsert.recent(source, target.limit(0), "ts").count() == 5


def test_upsert_replaces_inserts_and_is_idempotent(source, target):
    batch = upsert.recent(source, target, "ts")
    once = upsert.upsert(target, batch, ["id"])
    assert _rows(once) == [(1, "old"), (2, "new"), (3, "new"), (4, "new"), (5, "new")]
    assert _rows(upsert.upsert(once, batch, ["id"])) == _rows(once)


def test_changes_tell_actions_apart(spark, source, target):
    batch = upsert.recent(source, target, "ts").withColumn(
        "status", F.when(F.col("id") == 3, "old").otherwise(F.col("status"))
    )
    found = {r.action: r.row_count for r in upsert.changes(target, batch, ["id"]).collect()}
    assert found == {"inserted": 1, "updated": 2, "unchanged": 1, "untouched": 1}


def _read(spark, path, like):
    return spark.read.schema(like.schema).parquet(path)


def test_partitions_are_rewritten_only_where_touched(spark, source, target):
    path = staged_path(spark, "orders")
    part = lambda df: df.withColumn("day", F.date_format("ts", "dd"))
    upsert.upsert_partitions(spark, path, part(target), ["id"], ["day"])

    def first_file():
        return spark.read.parquet(f"{path}/day=01").select(F.input_file_name().alias("f")).first().f

    untouched = first_file()
    batch = part(upsert.recent(source, target, "ts"))
    for _ in range(2):  # the same batch twice changes nothing more
        upsert.upsert_partitions(spark, path, batch, ["id"], ["day"])
        stored = _read(spark, path, batch)
        assert _rows(stored) == [(1, "old"), (2, "new"), (3, "new"), (4, "new"), (5, "new")]
        # Folder names keep their text form.
        assert {r.day for r in stored.collect()} == {"01", "08", "09", "11", "12"}
    assert first_file() == untouched


def test_a_key_that_moves_leaves_no_copy_behind(spark, target):
    path = staged_path(spark, "moved")
    part = lambda df: df.withColumn("day", F.date_format("ts", "dd"))
    upsert.upsert_partitions(spark, path, part(target), ["id"], ["day"])
    moved = spark.createDataFrame([(4, _day(0), "moved"), (3, None, "no date")], SCHEMA)
    upsert.upsert_partitions(spark, path, part(moved), ["id"], ["day"])
    stored = _read(spark, path, part(moved))
    assert _rows(stored) == [(1, "old"), (2, "old"), (3, "no date"), (4, "moved")]
    # And out of the null partition again.
    back = spark.createDataFrame([(3, _day(8), "back")], SCHEMA)
    upsert.upsert_partitions(spark, path, part(back), ["id"], ["day"])
    assert _rows(_read(spark, path, part(moved))) == [
        (1, "old"), (2, "old"), (3, "back"), (4, "moved"),
    ]


def test_an_empty_batch_changes_nothing(spark, target):
    path = staged_path(spark, "still")
    part = lambda df: df.withColumn("day", F.date_format("ts", "dd"))
    upsert.upsert_partitions(spark, path, part(target), ["id"], ["day"])
    upsert.upsert_partitions(spark, path, part(target.limit(0)), ["id"], ["day"])
    assert _read(spark, path, part(target)).count() == 4


def test_change_rows_have_both_sides(spark, source, target):
    target = target.unionByName(spark.createDataFrame([(None, _day(9), "old")], SCHEMA))
    batch = source.where("id in (2, 5)").unionByName(
        spark.createDataFrame([(3, _day(8), "old"), (None, _day(9), "new")], SCHEMA)
    )
    found = {
        r.id: (r.action, r.before and r.before.status, r.after.status)
        for r in upsert.change_rows(target, batch, ["id"]).collect()
    }
    assert found == {2: ("updated", "old", "new"), 5: ("inserted", None, "new"), None: ("updated", "old", "new")}


def test_the_feed_has_a_repeated_batch_once(spark, source, target):
    path = staged_path(spark, "feed")
    rows = upsert.change_rows(target, source, ["id"])
    for batch in ("1", "2", "2"):
        upsert.append_changes(rows, path, batch)
    stored = spark.read.parquet(path)
    assert stored.count() == 2 * rows.count() and stored.select("batch_id").distinct().count() == 2
