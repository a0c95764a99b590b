"""Files that arrive in turns, merged as a stream."""

import datetime as dt

from pyspark.sql import functions as F

from mercatura.session import staged_path
from mercatura.streaming.incremental import Late, in_time, late_rows, merge_stream

SCHEMA = "order_id int, ts timestamp_ntz, status string, step int, day string"


def _day(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def _row(order, day, status, step):
    return order, _day(day), status, step, f"{_day(day):%Y-%m-%d}"


def _run(spark, inbox, table, marks):
    source = spark.readStream.schema(SCHEMA).parquet(inbox)
    merge_stream(
        source,
        table,
        marks,
        keys=["order_id"],
        newest_first=[F.col("step").desc()],
        partition_columns=["day"],
    ).awaitTermination()
    rows = spark.read.schema(SCHEMA).parquet(table).collect()
    return sorted((r.order_id, r.status) for r in rows)


def test_updates_late_rows_and_repeats(spark):
    inbox, table, marks = (staged_path(spark, f) for f in ("inbox", "table", "marks"))

    def arrive(*rows):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(inbox)

    arrive(_row(1, 0, "created", 1), _row(2, 10, "created", 1), _row(2, 10, "shipped", 2))
    assert _run(spark, inbox, table, marks) == [(1, "created"), (2, "shipped")]

    # Order 2 moves on, order 3 is new, and order 1's update is ten days late.
    arrive(_row(2, 10, "delivered", 3), _row(3, 8, "created", 1), _row(1, 0, "shipped", 2))
    after = [(1, "shipped"), (2, "delivered"), (3, "created")]
    assert _run(spark, inbox, table, marks) == after

    # Nothing new: nothing changes. An older version that arrives late: neither.
    assert _run(spark, inbox, table, marks) == after
    arrive(_row(2, 10, "shipped", 2))
    assert _run(spark, inbox, table, marks) == after


def test_a_backfill_gives_the_same_table_in_one_batch_or_many(spark):
    rows = [_row(i % 7, 40 * (i % 3), f"s{i}", i) for i in range(30)]
    found = []
    for size, arriving in ((30, rows), (8, rows[::-1])):
        inbox, table, marks = (staged_path(spark, f) for f in ("inbox", "table", "marks"))
        for start in range(0, len(rows), size):
            part = arriving[start : start + size]
            spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(inbox)
            got = _run(spark, inbox, table, marks)
        found.append(got)
    assert found[0] == found[1] and len(found[0]) == 7


def test_late_rows_are_kept_apart_and_a_replay_splits_alike(spark):
    inbox, table, marks, side = (staged_path(spark, f) for f in ("inbox", "table", "marks", "late"))
    late = Late("ts", dt.timedelta(days=5), side)
    like = spark.createDataFrame([], SCHEMA)

    def arrive(*rows):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(inbox)
        merge_stream(
            spark.readStream.schema(SCHEMA).parquet(inbox), table, marks, keys=["order_id"],
            newest_first=[F.col("step").desc()], partition_columns=["day"], late=late,
        ).awaitTermination()
        return sorted((r.order_id, r.status) for r in spark.read.schema(SCHEMA).parquet(table).collect())

    def kept():
        return sorted((r.order_id or 0, r.status, r.batch_id) for r in late_rows(spark, late, like).collect())

    # In the first batch nothing is late, whatever lies between its rows.
    assert arrive(_row(1, 0, "created", 1), _row(2, 30, "created", 1)) == [(1, "created"), (2, "created")]
    assert kept() == []
    # Newest is day 30: day 25 is in time, day 24 is not. A version out of order loses, no time is never late.
    second = [_row(3, 25, "shipped", 2), _row(3, 25, "created", 1), _row(4, 24, "created", 1), (5, None, "odd", 1, "x")]
    assert arrive(*second) == [(1, "created"), (2, "created"), (3, "shipped"), (5, "odd")]
    assert kept() == [(4, "created", 1)]
    for _ in range(2):  # the same micro-batch again
        again = in_time(spark.createDataFrame(second, SCHEMA), 1, late)
        assert sorted(r.order_id for r in again.collect()) == [3, 3, 5] and kept() == [(4, "created", 1)]
    # A batch of old rows only does not move the bound back.
    arrive(_row(6, 1, "created", 1))
    after = arrive(_row(7, 24, "created", 1), _row(8, 25, "created", 1))
    assert [r[0] for r in after] == [1, 2, 3, 5, 8]
    assert kept() == [(4, "created", 1), (6, "created", 2), (7, "created", 3)]


def test_null_keys_stay_one_row(spark):
    inbox, table, marks = (staged_path(spark, f) for f in ("inbox", "table", "marks"))
    for step in (1, 2, 2):
        rows = [(None, _day(0), f"s{step}", step, "2020-01-01"), (1, _day(0), "x", step, "2020-01-01")]
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(SCHEMA).parquet(inbox)
        merge_stream(
            source, table, marks, keys=["order_id"], newest_first=[F.col("step").desc()], partition_columns=["day"]
        ).awaitTermination()
    found = spark.read.schema(SCHEMA).parquet(table).collect()
    assert sorted((r.order_id or 0, r.step) for r in found) == [(0, 2), (1, 2)]
