"""An index of the keys of a versioned table: which partitions can hold a key, without reading keys.

    <table>/index/<hash of the key columns>/written=<id>/files   one row per partition folder and block

Each write of a table has its own index, made once and never changed, like the write itself. It is a bloom
filter per partition folder, cut into blocks of 256 bits. A key has one block, chosen by a hash,
and eight bits in it, chosen by another, two in each of four 64-bit words; blocks without a key are
not stored. Filters are sized by the keys of their folder, ``BITS_PER_KEY`` to twice as many bits each, at
which a key that is not there is told to be there about once in 100,000 times. A key that is there is
always found.

A merge asks the index which folders can hold an older copy of a batch row, and reads the keys of these
only. A write whose index is missing or was not finished counts as one that can hold any key, so a crash before
the index is whole costs reading, not rows.

The index is a table like others: it is made by one aggregation by (folder, block), so that a folder with
most of the rows spreads, and asked by a join on blocks.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from mercatura.session import drop_path, path_exists
from mercatura.sources import versions
from mercatura.sources.versions import WRITTEN, Version

BITS_PER_KEY = 32
BLOCK_BITS = 256
WORDS = 4
FEWEST_BLOCKS_LOG = 12
"""Filters have at least 2^12 blocks, so that the keys of a batch meet many of them in a small folder too."""
MOST_BLOCKS_LOG = 40

_BLOCK = StructType(
    [StructField("blocks_log", IntegerType()), StructField("block", LongType())]
    + [StructField(f"w{i}", LongType()) for i in range(WORDS)]
)


def index_path(path: str, version: Version, keys: Sequence[str]) -> str:
    """The folder goes by the names and types of the keys: other types have other hashes."""
    types = StructType.fromJson(json.loads(version.schema))
    named = StructType([StructField(k, types[k].dataType) for k in keys]).json()
    return f"{path}/index/{hashlib.md5(named.encode()).hexdigest()}"


def _hashes(keys: Sequence[str]) -> tuple[Column, Column]:
    """Where the block of a key is taken from, and its bits. Null keys have hashes like others."""
    nulls = [F.col(k).isNull() for k in keys]
    return F.xxhash64(*keys, *nulls), F.xxhash64(F.lit("bits"), *keys, *nulls)


def _power(exponent: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), exponent)


def _block(place: Column, blocks_log: Column) -> Column:
    return place.bitwiseAND(_power(blocks_log) - 1)


def _masks(bits: Column) -> list[Column]:
    """Two bits in each word, from six bits of the hash each."""

    def bit(n: int) -> Column:
        at = F.shiftrightunsigned(bits, 6 * n).bitwiseAND(F.lit(63)).cast("int")
        return _power(at)

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(WORDS)]


def _partition(columns: Sequence[str]) -> Column:
    """The partition of a row. Structs compare null-safe, so the null partition is one like others."""
    return F.struct(*columns) if columns else F.struct(F.lit(0).alias("whole"))


def _folder(partition: Row, columns: Sequence[str]) -> str:
    return versions.folder_of(partition) if columns else ""


def build(spark: SparkSession, path: str, version: Version, keys: Sequence[str], partitions: Sequence[str]) -> None:
    """Index the writes of ``version`` that have no index yet. Reads the key columns of these only."""
    home = index_path(path, version, keys)
    for written in _missing(spark, path, version, keys):
        # All that was written, also what the version does not name any more.
        folders = versions.folders_of(spark, path, written, len(partitions))
        mine = Version(version.number, dict.fromkeys(folders, written), version.schema)
        place, bits = _hashes(keys)
        rows = versions.read(spark, path, mine)
        rows = rows.select(_partition(partitions).alias("partition"), place.alias("place"), bits.alias("bits"))
        # Repeated keys only make a filter larger than it had to be.
        needed = F.log2(F.count(F.lit(1)) * F.lit(BITS_PER_KEY / BLOCK_BITS))
        blocks_log = F.least(F.greatest(F.ceil(needed), F.lit(FEWEST_BLOCKS_LOG)), F.lit(MOST_BLOCKS_LOG))
        sizes = rows.groupBy("partition").agg(blocks_log.cast("int").alias("blocks_log"))
        sized = rows.join(sizes, "partition")
        words = [F.bit_or(mask).alias(f"w{i}") for i, mask in enumerate(_masks(F.col("bits")))]
        block = _block(F.col("place"), F.col("blocks_log")).alias("block")
        blocks = sized.groupBy("partition", "blocks_log", block)
        blocks.agg(*words).write.mode("overwrite").parquet(f"{home}/{WRITTEN}={written}")


def _missing(spark: SparkSession, path: str, version: Version, keys: Sequence[str]) -> list[str]:
    """The writes of ``version`` without a whole index: the marker of a finished write decides."""
    home = index_path(path, version, keys)
    return [
        w
        for w in sorted(set(version.folders.values()))
        if not path_exists(spark, f"{home}/{WRITTEN}={w}/_SUCCESS")
    ]


def candidates(
    spark: SparkSession,
    path: str,
    version: Version,
    batch: DataFrame,
    keys: Sequence[str],
    partitions: Sequence[str],
) -> Version:
    """``version`` with only those partition folders that can hold a key of ``batch``."""
    missing = set(_missing(spark, path, version, keys))
    unknown = [f for f, w in version.folders.items() if w in missing]
    told = {f: w for f, w in version.folders.items() if w not in missing}
    if not told:
        return version
    home = index_path(path, version, keys)
    paths = [f"{home}/{WRITTEN}={w}" for w in sorted(set(told.values()))]
    # Hashes depend on the type, so keys are taken as the table has them.
    types = StructType.fromJson(json.loads(version.schema))
    partition = StructType([types[c] for c in partitions] or [StructField("whole", IntegerType())])
    schema = StructType([StructField("partition", partition), *_BLOCK.fields, StructField(WRITTEN, StringType())])
    index = spark.read.schema(schema).option("basePath", home).parquet(*paths)

    place, bits = _hashes(keys)
    probes = batch.select(*[F.col(k).cast(types[k].dataType).alias(k) for k in keys])
    probes = probes.select(place.alias("place"), bits.alias("bits"))
    masks = [mask.alias(f"m{i}") for i, mask in enumerate(_masks(F.col("bits")))]
    # Filters have at most MOST_BLOCKS_LOG sizes, usually a few.
    logs = [r.blocks_log for r in index.select("blocks_log").distinct().collect()]
    if not logs:
        return versions.only(version, unknown)
    sizes = F.explode(F.array(*[F.lit(log) for log in sorted(logs)])).alias("probe_log")
    probes = probes.select("place", *masks, sizes)
    probes = probes.withColumn("probe_block", _block(F.col("place"), F.col("probe_log"))).drop("place")
    met = (F.col("blocks_log") == F.col("probe_log")) & (F.col("block") == F.col("probe_block"))
    for i in range(WORDS):
        met = met & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    # At most one row per folder that the version's manifest names.
    hits = index.join(probes, met, "left_semi").select("partition", WRITTEN).distinct().collect()
    possible = [(_folder(hit["partition"], partitions), hit[WRITTEN]) for hit in hits]
    # A folder of an older write is not in the version any more.
    possible = [folder for folder, written in possible if told.get(folder) == written]
    return versions.only(version, [*unknown, *possible])


def expire(spark: SparkSession, path: str) -> list[str]:
    """Delete the indexes of writes that no kept version names; returns the ids of these. To be called
    after ``versions.expire``, when no writer is at work."""
    named = {w for n in versions.numbers(spark, path) for w in versions.pinned(spark, path, n).folders.values()}
    gone = []
    for home in versions.folder_names(spark, f"{path}/index"):
        for folder in versions.folder_names(spark, f"{path}/index/{home}"):
            if folder.removeprefix(f"{WRITTEN}=") not in named:
                drop_path(spark, f"{path}/index/{home}/{folder}")
                gone.append(folder.removeprefix(f"{WRITTEN}="))
    return gone
