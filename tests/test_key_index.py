"""The index of keys: what it lets a merge leave unread, and that it never hides a row."""

import glob

import pytest
from pyspark.sql import functions as F

from mercatura.operators import upsert
from mercatura.session import drop_path, staged_path
from mercatura.sources import key_index, versions

SCHEMA = "id string, day string, status string"
KEYS, PARTS = ["id"], ["day"]


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def merge(spark, path, *batch, **options):
    return upsert.upsert_version(spark, path, table(spark, *batch), KEYS, PARTS, indexed=True, **options)


def stored(spark, path):
    return sorted(map(tuple, versions.read(spark, path).select("id", "day", "status").collect()), key=str)


OLD = [("1", "01", "old"), ("2", "02", "old"), ("3", "a b/%", "old"), ("4", None, "old"), (None, "05", "old")]


@pytest.fixture
def path(spark):
    path = staged_path(spark, "indexed")
    merge(spark, path, *OLD)
    return path


def found(spark, path, *ids):
    batch = table(spark, *[(i, "99", "new") for i in ids])
    version = versions.latest(spark, path)
    return set(key_index.candidates(spark, path, version, batch, KEYS, PARTS).folders)


def spoil(path, folder):
    """Files of one partition that can no longer be read."""
    files = glob.glob(f"{path}/data/written=*/{folder}/*.parquet")
    assert files
    for file in files:
        open(file, "wb").write(b"no parquet")
        for crc in glob.glob(f"{file.rsplit('/', 1)[0]}/.*.crc"):
            open(crc, "wb").close()


def test_partitions_that_can_hold_a_key(spark, path):
    null = "day=__HIVE_DEFAULT_PARTITION__"
    assert found(spark, path, "1") == {"day=01"}
    assert found(spark, path, "3", "4", "9") == {"day=a b%2F%25", null}
    assert found(spark, path, None) == {"day=05"}
    assert found(spark, path, "9", "") == set() == found(spark, path)


def test_partitions_without_a_candidate_are_not_read(spark, path):
    spoil(path, "day=02")
    merge(spark, path, ("1", "07", "moved"), ("8", "08", "new"))
    version = versions.latest(spark, path)
    assert "day=01" not in version.folders and {"day=02", "day=07", "day=08"} <= set(version.folders)
    rest = versions.only(version, set(version.folders) - {"day=02"})
    assert {tuple(r) for r in versions.read(spark, path, rest).select("id", "status").collect()} == {
        ("1", "moved"), ("8", "new"), ("3", "old"), ("4", "old"), (None, "old"),
    }


def test_moved_keys_leave_no_copy_behind(spark, path):
    merge(spark, path, ("3", "01", "moved"), ("4", "02", "moved"), (None, None, "moved"))
    merge(spark, path, ("3", None, "again"))
    assert stored(spark, path) == sorted(
        [("1", "01", "old"), ("2", "02", "old"), ("3", None, "again"), ("4", "02", "moved"), (None, None, "moved")],
        key=str,
    )


def test_newest_first_finds_the_stored_copy(spark, path):
    newest = [F.col("status").desc_nulls_last()]
    merge(spark, path, ("1", "09", "later than 'old'"), ("2", "09", "zz"), newest_first=newest)
    assert ("1", "01", "old") in stored(spark, path) and ("2", "09", "zz") in stored(spark, path)


def test_a_write_without_a_whole_index_can_hold_any_key(spark, path):
    home = key_index.index_path(path, versions.latest(spark, path), KEYS)
    written = versions.latest(spark, path).folders["day=01"]
    merge(spark, path, ("8", "08", "new"))
    drop_path(spark, f"{home}/written={written}/_SUCCESS")
    assert found(spark, path, "9") == {f for f in versions.latest(spark, path).folders if f != "day=08"}
    merge(spark, path, ("1", "08", "moved"))  # and the next merge makes it whole
    assert ("1", "01", "old") not in stored(spark, path)
    assert found(spark, path, "9") == set()


def test_an_index_goes_with_its_versions(spark, path):
    first = set(versions.latest(spark, path).folders.values())
    merge(spark, path, *[(i, d, "new") for i, d, _ in OLD])
    assert key_index.expire(spark, path) == []
    versions.expire(spark, path, keep=1)
    assert set(key_index.expire(spark, path)) == first
    assert found(spark, path, "1") == {"day=01"}


def test_tables_without_partitions_and_several_keys(spark):
    path, keys = staged_path(spark, "flat"), ["a", "b"]
    rows = spark.createDataFrame([(1, None, "x"), (None, 1, "y")], "a int, b bigint, c string")
    versions.replace(rows, path)
    version = versions.latest(spark, path)
    key_index.build(spark, path, version, keys, [])
    batch = spark.createDataFrame([(1, None)], "a bigint, b int")  # other types than the table's
    assert key_index.candidates(spark, path, version, batch, keys, []).folders == version.folders
    assert not key_index.candidates(spark, path, version, batch.select("b", F.lit(2).alias("a")), keys, []).folders


def test_no_key_is_missed_and_few_are_told_wrongly(spark):
    """A hot partition holds most rows; keys that are not there seem to be in about one of 100,000."""
    path = staged_path(spark, "many")
    day = F.when(F.col("id") % 3 == 0, F.col("id") % 40).otherwise(77)
    rows = spark.range(400_000).select(F.md5(F.col("id").cast("string")).alias("id"), day.alias("day"))
    versions.replace(rows, path, ["day"])
    version = versions.latest(spark, path)
    key_index.build(spark, path, version, ["id"], ["day"])
    for day_, ids in ((77, rows.where("day = 77")), (39, rows.where("day = 39"))):
        one = key_index.candidates(spark, path, version, ids.limit(1), ["id"], ["day"])
        assert f"day={day_}" in one.folders
    absent = spark.range(1000, 1200).select(F.sha1(F.col("id").cast("string")).alias("id"))
    assert len(key_index.candidates(spark, path, version, absent, ["id"], ["day"]).folders) <= 1
    index = spark.read.parquet(key_index.index_path(path, version, ["id"]))
    place, bits = key_index._hashes(["id"])
    asked = spark.range(100_000).select(F.sha1(F.col("id").cast("string")).alias("id")).select(
        place.alias("place"), bits.alias("bits")
    )
    hot = index.where("partition.day = 77")
    log = hot.first().blocks_log
    masks = key_index._masks(F.col("bits"))
    words = [F.col(f"w{i}").bitwiseAND(mask) == mask for i, mask in enumerate(masks)]
    block = key_index._block(F.col("place"), F.lit(log))
    wrong = hot.join(asked.select("bits", block.alias("block")), "block").where(words[0] & words[1] & words[2] & words[3])
    assert wrong.count() <= 10
    everyone = rows.where("day = 77").select(place.alias("place"), bits.alias("bits"))
    right = hot.join(everyone.select("bits", block.alias("block")), "block").where(words[0] & words[1] & words[2] & words[3])
    assert right.count() == everyone.count()
