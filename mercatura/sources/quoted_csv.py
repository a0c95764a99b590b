"""CSV files with line breaks inside quotes, read by several tasks per file.

A block of a file cannot tell by itself whether it starts inside quotes. So the lines of each block are looked
at for both cases at once: the number of quotes before a line, counted from the block's start, says which lines
begin a record if the block starts outside quotes, and which if it starts inside. The quotes of the
blocks before, summed per file, then say which case holds. Lines that are whole records go on as
they are; only the lines of broken ones, and of those that cross into other blocks, are shuffled to be
joined again. Records are parsed by Spark's own CSV parser.

Quotes are taken to come in pairs inside a record, as in every file that a CSV writer makes (quotes around
a field, and two for one inside). ``odd_files`` finds files where they do not. Lines end with a line feed or
carriage return and line feed. Compressed files are one block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercatura.session import stage

BLOCK_BYTES = "spark.sql.files.maxPartitionBytes"


_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}


def session_block(spark: SparkSession) -> int:
    """Bytes of a block of the session's scans."""
    text = spark.conf.get(BLOCK_BYTES).lower().removesuffix("b") or "0"
    return int(text) if text.isdigit() else int(text[:-1]) * _UNITS[text[-1]]


@contextmanager
def block_size(spark: SparkSession, size: int | None) -> Iterator[None]:
    """Blocks of ``size`` bytes for the scans that run inside; None leaves the session's."""
    before = spark.conf.get(BLOCK_BYTES)
    if size is not None:
        spark.conf.set(BLOCK_BYTES, size)
    try:
        yield
    finally:
        spark.conf.set(BLOCK_BYTES, before)


def _lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """One row per line: file, block (its first byte), seq (order in the block), value, quotes before it in the
    block modulo 2 (odd), and the line that begins the record it is in for both cases, null if an earlier
    block does."""
    read = spark.read.text(list(files), lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
        F.regexp_count("value", F.lit('"')).alias("quotes"),
    )
    in_block = Window.partitionBy("file", "block").orderBy("seq")
    before = F.coalesce(F.sum("quotes").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = read.withColumn("odd", before % 2)
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumns(
        {
            f"begun_{case}": F.last(F.when(F.col("odd") == case, F.col("seq")), ignorenulls=True).over(so_far)
            for case in (0, 1)
        }
    )


def _blocks(lines: DataFrame) -> DataFrame:
    """One row per block: whether it starts inside quotes, the record that is open there, and the
    file's header line."""
    has_text = F.trim(F.translate("value", "\r﻿", "")) != ""
    blocks = lines.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("odd_quotes"),
        *[F.max(F.when(F.col("odd") == case, F.col("seq"))).alias(f"last_{case}") for case in (0, 1)],
        F.min(F.when(has_text, F.col("seq"))).alias("first"),
    )
    # One row per block: a file of a terabyte has some thousands.
    in_file = Window.partitionBy("file").orderBy("block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd_quotes").over(earlier), F.lit(0)) % 2
    blocks = blocks.withColumn("inside", inside)
    last = F.when(F.col("inside") == 0, F.col("last_0")).otherwise(F.col("last_1"))
    return blocks.select(
        F.col("file").alias("of_file"),
        F.col("block").alias("of_block"),
        "inside",
        F.last(last, ignorenulls=True).over(earlier).alias("open"),
        F.first("first", ignorenulls=True)
        .over(in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("header"),
    )


def records(spark: SparkSession, files: Sequence[str], block_bytes: int | None = None) -> DataFrame:
    """(file, value): the records of the files as text, without each file's first one, the header, and
    without blank lines."""
    with block_size(spark, block_bytes):
        lines = stage(_lines(spark, files), "lines")
    blocks = stage(_blocks(lines), "blocks")
    same = (F.col("file") == F.col("of_file")) & (F.col("block") == F.col("of_block"))
    placed = lines.join(blocks, same)
    begins = F.col("odd") == F.col("inside")
    closes = (F.col("odd") + F.col("quotes")) % 2 == F.col("inside")
    begun = F.when(F.col("inside") == 0, F.col("begun_0")).otherwise(F.col("begun_1"))
    placed = placed.withColumn("record", F.coalesce(begun, F.col("open")))
    placed = placed.where(~F.col("record").eqNullSafe(F.col("header")))
    whole = placed.where(begins & closes).select("file", "value")
    broken = placed.where(~(begins & closes)).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "value"))).alias("parts")
    )
    joined = broken.select("file", F.array_join(F.col("parts.value"), "\n").alias("value"))
    ended = whole.unionByName(joined).select("file", F.regexp_replace("value", "\r$", "").alias("value"))
    return ended.where(F.trim("value") != "")


def odd_files(spark: SparkSession, files: Sequence[str]) -> set[str]:
    """Files whose quotes do not come in pairs; their records cannot be told from the quotes."""
    counted = spark.read.text(list(files), lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.regexp_count("value", F.lit('"')).alias("quotes")
    )
    odd = counted.groupBy("file").agg(F.sum("quotes").alias("quotes")).where("quotes % 2 = 1")
    # Spark tells names as escaped addresses.
    path, uri = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.java.net.URI
    return {path(uri(r.file)).toString() for r in odd.collect()}


def read(
    spark: SparkSession,
    files: Sequence[str],
    schema: StructType,
    malformed: str,
    block_bytes: int | None = None,
) -> DataFrame:
    """The rows of files that share a header, parsed like ``spark.read.csv`` with ``multiLine`` does;
    the column ``malformed`` of ``schema`` has the text of rows that do not fit."""
    options = {
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": malformed,
        "multiLine": "true",
    }
    escaped = [(f.name.replace("`", "``"), f.dataType.simpleString()) for f in schema.fields]
    parsed = F.from_csv("value", ", ".join(f"`{name}` {kind}" for name, kind in escaped), options)
    return records(spark, files, block_bytes).select(parsed.alias("row")).select("row.*")
