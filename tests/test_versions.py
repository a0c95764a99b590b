"""Versioned tables: whole at every step, pinned readers, conflicts, expiry."""

import pytest
from pyspark.sql import functions as F

from mercatura.operators import upsert
from mercatura.session import staged_path
from mercatura.sources import versions

SCHEMA = "id int, day string, status string"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(df):
    return sorted(map(tuple, df.select("id", "day", "status").collect()), key=str)


@pytest.fixture
def path(spark):
    path = staged_path(spark, "versioned")
    first = table(spark, (1, "01", "old"), (2, "02", "old"), (3, "02", "old"), (4, None, "old"))
    versions.replace(first, path, ["day"])
    return path


OLD = [(1, "01", "old"), (2, "02", "old"), (3, "02", "old"), (4, None, "old")]


def merge(spark, path, *batch, **options):
    return upsert.upsert_version(spark, path, table(spark, *batch), ["id"], ["day"], **options)


def test_readers_stay_with_their_version(spark, path):
    before = versions.read(spark, path)
    made = merge(spark, path, (2, "02", "new"), (5, "05", "new"))
    assert made.number == 2 and versions.numbers(spark, path) == [1, 2]
    assert rows(before) == rows(versions.read(spark, path, 1)) == sorted(OLD, key=str)
    new = [(1, "01", "old"), (2, "02", "new"), (3, "02", "old"), (4, None, "old"), (5, "05", "new")]
    assert rows(versions.read(spark, path)) == sorted(new, key=str)


def test_untouched_folders_are_shared_and_emptied_ones_go(spark, path):
    first = versions.latest(spark, path)
    second = merge(spark, path, (1, "02", "moved"), (4, "07", "moved"))
    assert "day=01" not in second.folders and f"day={versions.NULL_FOLDER}" not in second.folders
    assert second.folders["day=02"] != first.folders["day=02"]
    third = merge(spark, path, (1, "02", "again"))
    assert third.folders["day=07"] == second.folders["day=07"]
    assert rows(versions.read(spark, path)) == [
        (1, "02", "again"), (2, "02", "old"), (3, "02", "old"), (4, "07", "moved"),
    ]


class Killed(RuntimeError):
    pass


def killed(*_, **__):
    raise Killed


STEPS = ["write_folder", "folders_of", "publish", "pending", "claimed"]


@pytest.mark.parametrize("step", STEPS)
def test_a_writer_killed_at_any_step_leaves_the_old_version(spark, path, monkeypatch, step):
    with monkeypatch.context() as patch:
        if step == "claimed":  # right after the claim is made, before the manifest is renamed
            write = versions._write_text

            def claim(spark, path, text, must_be_new=False):
                done = write(spark, path, text, must_be_new)
                if must_be_new:
                    raise Killed
                return done

            patch.setattr(versions, "_write_text", claim)
        elif step == "pending":  # the manifest is written under its other name only
            write = versions._write_text
            patch.setattr(
                versions,
                "_write_text",
                lambda s, p, text, must_be_new=False: killed() if must_be_new else write(s, p, text),
            )
        else:
            patch.setattr(versions, step, killed)
        with pytest.raises(Killed):
            merge(spark, path, (1, "01", "lost"))
    assert rows(versions.read(spark, path)) == sorted(OLD, key=str)
    made = merge(spark, path, (1, "01", "kept"))
    assert rows(versions.read(spark, path)) == rows(versions.read(spark, path, made.number))
    assert (1, "01", "kept") in rows(versions.read(spark, path))
    # What the dead writer left is named by no version, and can go.
    versions.drop_unnamed(spark, path)
    assert (1, "01", "kept") in rows(versions.read(spark, path)) and rows(versions.read(spark, path, 1))


def test_two_writers_from_one_version(spark, path):
    base = versions.latest(spark, path)
    merge(spark, path, (1, "01", "winner"))
    with pytest.raises(versions.VersionConflict):
        versions.replace_partitions(table(spark, (1, "01", "loser")), path, base, ["day"], ["day=01"])
    assert (1, "01", "winner") in rows(versions.read(spark, path))


def test_expiry_keeps_what_kept_versions_name(spark, path):
    for n in range(3):
        merge(spark, path, (1, "01", f"run {n}"))
    newest = rows(versions.read(spark, path))
    assert versions.expire(spark, path, keep=2) == [1, 2]
    assert versions.numbers(spark, path) == [3, 4]
    assert rows(versions.read(spark, path)) == newest and len(newest) == 4
    assert (1, "01", "run 1") in rows(versions.read(spark, path, 3))
    with pytest.raises(Exception):
        versions.read(spark, path, 1)


def test_a_replayed_batch_with_null_keys_changes_nothing(spark, path):
    batch = [(None, "01", "no key"), (2, "02", "new")]
    merge(spark, path, *batch)
    once = rows(versions.read(spark, path))
    for _ in range(2):
        merge(spark, path, *batch, newest_first=[F.col("status")])
        merge(spark, path, *batch)
    assert rows(versions.read(spark, path)) == once and len(once) == 5


def test_odd_partition_names_and_empty_tables(spark):
    path = staged_path(spark, "odd")
    odd = [(1, "a/b=c", "x"), (2, "100%", "x"), (3, "", "x"), (4, "ü 1", "x"), (5, "[x]{y}*?", "x")]
    versions.replace(table(spark, *odd), path, ["day"])
    merge(spark, path, (1, "a/b=c", "y"), (2, "100%", "y"), (4, "ü 1", "y"), (5, "[x]{y}*?", "y"))
    found = rows(versions.read(spark, path))
    assert [(r[0], r[2]) for r in found] == [(1, "y"), (2, "y"), (3, "x"), (4, "y"), (5, "y")]
    empty = staged_path(spark, "empty")
    assert versions.latest(spark, empty) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark, empty)
    versions.replace(table(spark), empty, ["day"])
    assert versions.read(spark, empty).count() == 0
    assert merge(spark, empty).number == 1
    merge(spark, empty, (1, "01", "first"))
    assert rows(versions.read(spark, empty)) == [(1, "01", "first")]


def test_whole_tables_without_partitions(spark):
    path = staged_path(spark, "whole")

    def check(count):
        if count != 2:
            raise ValueError(count)

    versions.replace(table(spark, (1, "a", "x"), (2, "b", "x")), path, sort_key="id", check=check)
    with pytest.raises(ValueError):
        versions.replace(table(spark, (1, "a", "y")), path, check=check)
    assert rows(versions.read(spark, path)) == [(1, "a", "x"), (2, "b", "x")]
