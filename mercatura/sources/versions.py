"""Tables whose every version stays whole: immutable folders, a manifest per version, one atomic step.

    <table>/data/written=<id>/[<partition folders>/]files   never changed once written
    <table>/versions/<number>.json                          the folders that make up a version

A write goes to a folder of its own. Its manifest, finished under another name, then takes the next number: the
number is claimed by creating a file that must not exist yet, and the manifest is renamed
into place whole. A writer that dies before that leaves files no manifest names. A reader is pinned to the
folders of one manifest, so it never sees half of two versions, and a merge that replaces a few
partitions names the old folders of all others. ``expire`` deletes what no kept version names.

A manifest has one line per partition folder, not per file, so it grows with the partitions of the
table; Spark lists the files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercatura.session import drop_path, path_exists

WRITTEN = "written"
_DIGITS = 12


class VersionConflict(RuntimeError):
    """Another writer has published a version since this one read the table."""


@dataclass(frozen=True)
class Version:
    """A number, and the write that made each partition folder ('' for a table without partitions)."""

    number: int
    folders: dict[str, str] = field(default_factory=dict)
    schema: str | None = None


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def folder_names(spark: SparkSession, path: str) -> list[str]:
    if not path_exists(spark, path):
        return []
    fs, folder = _fs(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(folder))


def _write_text(spark: SparkSession, path: str, text: str, must_be_new: bool = False) -> bool:
    """Write a small file; False if it must be new and is not."""
    fs, file = _fs(spark, path)
    try:
        out = fs.create(file, not must_be_new)
    except Exception:
        if must_be_new and fs.exists(file):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def _read_text(spark: SparkSession, path: str) -> str:
    fs, file = _fs(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# The characters that folder names hold as % and two digits, and the name for null.
ESCAPED = set("\"#%'*/:=?\\\x7f{[]^") | {chr(c) for c in range(32)}
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def folder_of(row: Row) -> str:
    """The partition folder of a row of partition columns, as Spark names it."""

    def name(value: object) -> str:
        if value is None or value == "":
            return NULL_FOLDER
        return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in str(value))

    return "/".join(f"{column}={name(value)}" for column, value in row.asDict().items())


def _manifest(path: str, number: int) -> str:
    return f"{path}/versions/{number:0{_DIGITS}d}.json"


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions of a table that can be read, oldest first."""
    return [int(n.removesuffix(".json")) for n in folder_names(spark, f"{path}/versions") if n.endswith(".json")]


def latest(spark: SparkSession, path: str) -> Version | None:
    """The newest version of the table at ``path``, None before the first one."""
    found = numbers(spark, path)
    return pinned(spark, path, found[-1]) if found else None


def pinned(spark: SparkSession, path: str, number: int) -> Version:
    told = json.loads(_read_text(spark, _manifest(path, number)))
    return Version(number, told["folders"], told["schema"])


def read(spark: SparkSession, path: str, version: int | Version | None = None) -> DataFrame:
    """One version of a table, the newest by default; later writes do not change what it holds."""
    if version is None:
        version = latest(spark, path)
        if version is None:
            raise FileNotFoundError(f"{path} has no version")
    elif isinstance(version, int):
        version = pinned(spark, path, version)
    schema = StructType.fromJson(json.loads(version.schema))
    if not version.folders:
        return spark.createDataFrame([], schema)
    data = f"{path}/data"
    paths = [f"{data}/{WRITTEN}={w}{'/' + part if part else ''}" for part, w in sorted(version.folders.items())]
    # With the schema given, folder names such as '08' stay text.
    whole = StructType(schema.fields).add(WRITTEN, "string")
    reader = spark.read.schema(whole).option("basePath", data)
    return reader.parquet(*paths).drop(WRITTEN)


def write_folder(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_key: str | None = None
) -> tuple[str, int]:
    """Write rows to a folder of their own that no version names yet: its id and the rows written."""
    written, seen = uuid.uuid4().hex, Observation()
    if partition_by and sort_key:
        # Rows to be sorted are dealt by their content: rebalancing goes by compressed bytes, and a partition of
        # rows that compress well would be sorted by a task or two.
        told = [c for c, kind in df.dtypes if "map<" not in kind]
        df = df.repartition(*partition_by, F.xxhash64(*told))
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_key:
        df = df.sortWithinPartitions(*partition_by, sort_key)
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    target = f"{path}/data/{WRITTEN}={written}"
    try:
        writer.option("compression", "snappy").parquet(target)
    except Exception:
        drop_path(df.sparkSession, target)
        raise
    return written, seen.get["rows"]


def folders_of(spark: SparkSession, path: str, written: str, depth: int) -> list[str]:
    """The partition folders, ``depth`` levels deep, that a write has made."""
    found = [""]
    for _ in range(depth):
        found = [
            f"{above}/{name}".strip("/")
            for above in found
            for name in folder_names(spark, f"{path}/data/{WRITTEN}={written}/{above}".rstrip("/"))
            if "=" in name
        ]
    return found


def publish(
    spark: SparkSession, path: str, base: Version | None, folders: dict[str, str], schema: StructType
) -> Version:
    """Make ``folders`` the next version after ``base``; raises ``VersionConflict`` if another came between.

    A number that was claimed but never published belongs to a writer that died, and is left out.
    """
    last = base.number if base else 0
    pending = f"{path}/versions/pending-{uuid.uuid4().hex}"
    told = json.dumps({"folders": folders, "schema": schema.json()}, indent=0)
    _write_text(spark, pending, told)
    number = last + 1
    while True:
        known = numbers(spark, path)
        if (known[-1] if known else 0) != last:
            drop_path(spark, pending)
            raise VersionConflict(f"{path} is at version {known[-1]}, this write started from {last}")
        if _write_text(spark, f"{path}/versions/{number:0{_DIGITS}d}.claim", "", must_be_new=True):
            break
        number += 1
    fs, source = _fs(spark, pending)
    if not fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(_manifest(path, number))):
        raise RuntimeError(f"cannot publish version {number} of {path}")
    if numbers(spark, path)[-1] != number:
        raise VersionConflict(f"{path}: version {number} was overtaken by another writer")
    return Version(number, folders, schema.json())


def replace(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_key: str | None = None,
    check: Callable[[int], None] | None = None,
) -> Version:
    """The whole table anew, as its next version. ``check`` is given the rows written and may raise."""
    spark = df.sparkSession
    base = latest(spark, path)
    written, rows = write_folder(df, path, partition_by, sort_key)
    try:
        if check is not None:
            check(rows)
    except Exception:
        drop_path(spark, f"{path}/data/{WRITTEN}={written}")
        raise
    folders = {f: written for f in folders_of(spark, path, written, len(partition_by))}
    return publish(spark, path, base, folders, _ordered(df, partition_by))


def replace_partitions(
    df: DataFrame, path: str, base: Version, partition_by: Sequence[str], touched: Iterable[str]
) -> Version:
    """The next version after ``base``: rows of ``df`` instead of the partition folders ``touched``, the files
    of all others as they are."""
    spark = df.sparkSession
    written, _ = write_folder(df, path, partition_by)
    gone = set(touched)
    folders = {f: w for f, w in base.folders.items() if f not in gone}
    folders |= {f: written for f in folders_of(spark, path, written, len(partition_by))}
    return publish(spark, path, base, folders, _ordered(df, partition_by))


def only(version: Version, folders: Iterable[str]) -> Version:
    """``version`` with some of its partition folders only."""
    wanted = set(folders)
    kept = {f: w for f, w in version.folders.items() if f in wanted}
    return Version(version.number, kept, version.schema)


def _ordered(df: DataFrame, partition_by: Sequence[str]) -> StructType:
    return df.select(*[c for c in df.columns if c not in partition_by], *partition_by).schema


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` versions and the folders only these name; returns the
    numbers deleted.

    Folders of writes that no version has named yet stay: they may be in progress.
    ``drop_unnamed`` deletes these when no writer is at work. Readers of a deleted version fail.
    """
    found = numbers(spark, path)
    old = found[:-keep] if keep else found
    kept = {w for n in found[len(old) :] for w in _folders(pinned(spark, path, n))}
    for number in old:
        for folder in _folders(pinned(spark, path, number)) - kept:
            drop_path(spark, f"{path}/data/{folder}")
        drop_path(spark, _manifest(path, number))
    return old


def _folders(version: Version) -> set[str]:
    return {f"{WRITTEN}={w}/{part}".rstrip("/") for part, w in version.folders.items()}


def drop_unnamed(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders of writes no version names, left by writers that died; returns their ids."""
    named = {w for n in numbers(spark, path) for w in pinned(spark, path, n).folders.values()}
    gone = [f for f in folder_names(spark, f"{path}/data") if f.removeprefix(f"{WRITTEN}=") not in named]
    for folder in gone:
        drop_path(spark, f"{path}/data/{folder}")
    return [f.removeprefix(f"{WRITTEN}=") for f in gone]
