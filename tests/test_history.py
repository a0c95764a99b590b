"""Slowly changing dimensions and the as-of join."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mercatura.operators import history
from mercatura.sources import versions as stored_tables

R1, R2, R3 = (dt.datetime(2020, m, 1) for m in (1, 2, 3))
SCHEMA = "id int, name string, city string, state string"
CHECKS = ["city", "state"]


@pytest.fixture
def versions(spark):
    first = spark.createDataFrame(
        [
            (1, "same", "a", "X"),
            (2, "moves", "a", "X"),
            (3, "leaves", "a", "X"),
            (4, "gets city", None, "X"),
            (5, "renamed", "a", "X"),
        ],
        SCHEMA,
    )
    second = spark.createDataFrame(
        [
            (1, "same", "a", "X"),
            (2, "moves", "b", "X"),
            (4, "gets city", "c", "X"),
            (5, "new name", "a", "X"),
            (6, "arrives", "a", "X"),
        ],
        SCHEMA,
    )
    return history.apply_snapshot(history.first_snapshot(first, R1), second, "id", CHECKS, R2)


def _rows(df):
    return sorted(
        (r.id, r.name, r.city, r.dbt_valid_from, r.dbt_valid_to) for r in df.collect()
    )


def test_changed_rows_close_and_open(versions):
    assert _rows(versions.where("id = 2")) == [
        (2, "moves", "a", R1, R2),
        (2, "moves", "b", R2, None),
    ]


def test_null_to_value_is_a_change(versions):
    assert [(r[2], r[3], r[4]) for r in _rows(versions.where("id = 4").fillna("-", ["city"]))] == [
        ("-", R1, R2),
        ("c", R2, None),
    ]


def test_same_missing_unchecked_and_new_rows(versions):
    assert _rows(versions.where("id in (1, 3, 5, 6)")) == [
        (1, "same", "a", R1, None),
        (3, "leaves", "a", R1, None),
        (5, "renamed", "a", R1, None),  # the name is no check column
        (6, "arrives", "a", R2, None),
    ]


def test_third_run_keeps_closed_rows_and_periods_do_not_overlap(spark, versions):
    third = spark.createDataFrame([(2, "moves", "a", "X"), (1, "same", "a", "X")], SCHEMA)
    after = history.apply_snapshot(versions, third, "id", CHECKS, R3)
    assert _rows(after.where("id = 2")) == [
        (2, "moves", "a", R1, R2),
        (2, "moves", "a", R3, None),
        (2, "moves", "b", R2, R3),
    ]
    a, b = after.alias("a"), after.alias("b")
    both = a.join(b, (F.col("a.id") == F.col("b.id")))
    overlap = both.where(
        (F.col("a.dbt_valid_from") < F.col("b.dbt_valid_from"))
        & (F.col("a.dbt_valid_to").isNull() | (F.col("a.dbt_valid_to") > F.col("b.dbt_valid_from")))
    )
    assert overlap.count() == 0
    assert history.current_rows(after).groupBy("id").count().where("count > 1").count() == 0
    assert history.apply_snapshot(after, third, "id", CHECKS, R3).count() == after.count()


def _files(folder):
    return {p.relative_to(folder): p.read_bytes() for p in Path(folder).rglob("*.parquet")}


def test_stored_history_equals_the_computed_one_and_keeps_closed_files(spark, tmp_path):
    path = str(tmp_path / "history")
    rng = random.Random(1)
    current, computed = {i: "a" for i in range(40)}, None
    closed_before = {}
    for day in range(1, 6):
        run = dt.datetime(2021, 1, day)
        for i in rng.sample(sorted(current), 12):
            current[i] = rng.choice("abc")
        current[100 + day] = "new"
        table = spark.createDataFrame([(i, "n", c, "X") for i, c in current.items()], SCHEMA)
        for _ in range(2):  # a run that is repeated changes nothing
            history.append_snapshot(spark, path, table, "id", CHECKS, run)
        first = history.first_snapshot(table, run)
        computed = first if computed is None else history.apply_snapshot(computed, table, "id", CHECKS, run)
        assert _rows_text(history.stored_history(spark, path)) == _rows_text(computed)
        files = _files(path)
        assert all(files[name] == data for name, data in closed_before.items())
        closed_before = {n: d for n, d in files.items() if "__HIVE_DEFAULT" not in str(n)}
    open_row = F.col("dbt_valid_to").isNull()
    stored = stored_tables.read(spark, path)
    assert stored.where(open_row).select("closed_at").distinct().collect()[0][0] is None
    assert stored.where(~open_row).where("closed_at is null").count() == 0


def _rows_text(df):
    return sorted(str(tuple(r)) for r in df.select("id", "city", "dbt_valid_from", "dbt_valid_to").collect())


def test_a_run_reads_no_closed_rows(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "h"), []
    for day, city in ((1, "a"), (2, "b"), (3, "c")):
        table = spark.createDataFrame([(i, "n", city, "X") for i in range(9)], SCHEMA)
        history.append_snapshot(spark, path, table, "id", CHECKS, dt.datetime(2021, 1, day))
    apply = history.apply_snapshot
    monkeypatch.setattr(history, "apply_snapshot", lambda old, *rest: seen.append(old) or apply(old, *rest))
    history.append_snapshot(spark, path, table, "id", CHECKS, dt.datetime(2021, 1, 4))
    assert seen[0].count() == 9 and history.stored_history(spark, path).count() == 27


def test_current_flag(versions):
    flagged = history.with_current_flag(versions)
    assert flagged.where("is_current").count() == history.current_rows(versions).count() == 6


def test_as_of_join_takes_the_version_of_the_moment(spark, versions):
    day = dt.timedelta(days=1)
    facts = spark.createDataFrame(
        [(10, 2, R1 - day), (11, 2, R1), (12, 2, R2 - day), (13, 2, R2), (14, 99, R2)],
        "fact int, id int, ts timestamp_ntz",
    )
    cities = versions.select("id", "city", "dbt_valid_from", "dbt_valid_to")
    joined = history.as_of_join(facts, cities, "id", "ts")
    assert {r.fact: r.city for r in joined.collect()} == {
        10: None, 11: "a", 12: "a", 13: "b", 14: None,
    }


def test_snapshots_need_a_unique_key(spark):
    for rows, told in ([(1,), (1,)], "0 rows without it, 1 keys"), ([(None,), (2,)], "1 rows"):
        with pytest.raises(history.SnapshotKeyError, match=told):
            history.require_snapshot_key(spark.createDataFrame(rows, "k int"), "k")
    assert history.require_snapshot_key(spark.range(3), "id").count() == 3


def _plain(rows, versions, backdate=False):
    """The version of each fact by looking at all versions of its key."""
    out = []
    for fact, key, ts in rows:
        found = None
        mine = sorted(v for v in versions if v[0] == key and key is not None)
        for at, (_, start, end, name) in enumerate(mine):
            began = ts is not None and (start <= ts or (backdate and at == 0))
            if began and (end is None or ts < end):
                found = name
        out.append((fact, found))
    return out


@pytest.mark.parametrize("backdate", [False, True])
def test_as_of_join_with_hot_keys_nulls_gaps_and_ties(spark, backdate):
    """A third of the facts have one key, and half of these one instant."""
    day = dt.timedelta(days=1)
    versions = [(1, R1 + i * day, R1 + (i + 1) * day, f"v{i}") for i in range(50)]
    versions += [(2, R1, R1 + day, "a"), (2, R1 + 3 * day, None, "b"), (3, R2, None, "c")]
    rows = [(i, 1, R1 + 7 * day if i % 2 else R1 + (i % 60) * day) for i in range(400)]
    rows += [(1000 + i, 2 + i % 3, R1 + (i % 40 - 5) * day) for i in range(700)]
    rows += [(2000, None, R1), (2001, 2, None), (2002, None, None), (2003, 1, R1 - day)] * 2
    history_table = spark.createDataFrame(
        versions, "id int, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz, name string"
    )
    facts = spark.createDataFrame(rows, "fact int, id int, ts timestamp_ntz").repartition(5)
    joined = history.as_of_join(facts, history_table, "id", "ts", backdate)
    found = [(r.fact, r["name"]) for r in joined.collect()]
    assert sorted(found, key=str) == sorted(_plain(rows, versions, backdate), key=str)
    assert joined.columns == ["fact", "id", "ts", "dbt_valid_from", "dbt_valid_to", "name"]
    assert history.as_of_join(facts.limit(0), history_table, "id", "ts", backdate).count() == 0
    assert history.as_of_join(facts, history_table.limit(0), "id", "ts", backdate).where("name is null").count() == len(rows)


def test_as_of_join_spreads_a_hot_key(spark, monkeypatch):
    """Facts of one key and one instant lie in several partitions of the sort."""
    versions = spark.createDataFrame(
        [(7, R1, None, "x")], "id int, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz, name string"
    )
    facts = spark.range(0, 40_000, 1, 8).select(
        F.col("id").alias("fact"), F.lit(7).alias("id"), F.lit(R2).cast("timestamp_ntz").alias("ts")
    )
    seen, stage, merge = [], history.stage, "spark.sql.adaptive.coalescePartitions.enabled"
    monkeypatch.setattr(history, "stage", lambda df, label: seen.append(stage(df, label)) or seen[-1])
    spark.conf.set(merge, "false")  # so small a table would become one partition
    try:
        joined = history.as_of_join(facts, versions, "id", "ts")
    finally:
        spark.conf.set(merge, "true")
    sizes = [r["count"] for r in seen[0].groupBy(F.shiftright("place", 33).alias("p")).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 20_000
    assert joined.where("name = 'x'").count() == 40_000


def test_names_must_not_clash(spark, versions):
    facts = spark.createDataFrame([(1, "a", R1)], "id int, city string, ts timestamp_ntz")
    with pytest.raises(ValueError, match="city"):
        history.as_of_join(facts, versions, "id", "ts")


def test_sorted_rows_of_one_partition_are_dealt_over_tasks(spark, tmp_path):
    """Open rows are one partition, and compress well: bytes do not tell how many a task gets to sort."""
    path, merge = str(tmp_path / "h"), "spark.sql.adaptive.coalescePartitions.enabled"
    table = spark.range(2_000).select(F.col("id").cast("int"), *[F.lit("a").alias(c) for c in ("name", "city", "state")])
    spark.conf.set(merge, "false")  # so small a table would become one partition
    try:
        history.append_snapshot(spark, path, table, "id", CHECKS, R1)
    finally:
        spark.conf.set(merge, "true")
    assert len(_files(path)) >= 4 and history.stored_history(spark, path).count() == 2_000


def test_first_versions_are_found_without_reading_the_history_twice(spark):
    stored = spark.range(10).selectExpr(
        "id", "timestamp_ntz '2020-01-01' as dbt_valid_from", "cast(null as timestamp_ntz) as dbt_valid_to"
    )
    plan = history._version_starts(stored, "id", True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 10") == 1
