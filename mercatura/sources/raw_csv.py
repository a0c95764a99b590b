"""Raw CSV to typed, partitioned Parquet: read, repair, type, check the contract."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.functions.calendar import parse_timestamp
from mercatura.sources import quoted_csv
from mercatura.sources.contracts import Contract

# What a column of mixed types is split into.
TYPE_SUFFIXES = ("_string", "_long", "_double", "_int", "_boolean")
PARTITION_COLUMNS = ("partition_year", "partition_month")


MALFORMED = "_malformed"
"""Text of a row with more or fewer fields than its file's header; null for all others."""


class HeaderMissing(RuntimeError):
    """A delivered file has no header, so nothing tells what its rows are."""


class SourceFile(NamedTuple):
    name: str
    size: int
    header: tuple[str, ...]
    blank_start: bool


def _files(spark: SparkSession, path: str) -> list[SourceFile]:
    """The files under ``path``, in subfolders too, with the names in their first line that has any text.

    Only the start of each file is read. Compressed files are opened by the codec of their
    ending. Names that start with a dot or an underscore are not data.
    """
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()
    root = hadoop.fs.Path(path)
    files = root.getFileSystem(conf)
    codecs = hadoop.io.compress.CompressionCodecFactory(conf)
    found, folders = [], [root]
    while folders:
        for status in files.listStatus(folders.pop()):
            if status.getPath().getName()[0] in "._":
                continue
            (folders if status.isDirectory() else found).append(
                status.getPath() if status.isDirectory() else status
            )

    def first_line(status) -> SourceFile:
        file = status.getPath()
        stream, codec = files.open(file), codecs.getCodec(file)
        if codec is not None:
            stream = codec.createInputStream(stream)
        reader = spark._jvm.java.io.BufferedReader(
            spark._jvm.java.io.InputStreamReader(stream, "UTF-8")
        )
        try:
            line, blank = reader.readLine(), False
            while line is not None and not line.strip("\ufeff\r\n "):
                line, blank = reader.readLine(), True
        finally:
            reader.close()
        if line is None:
            raise HeaderMissing(f"{file.toString()} has no header")
        names = next(csv.reader([line.lstrip("\ufeff")]), [])
        header = tuple(name.strip("\ufeff\r\n\"' ") for name in names)
        return SourceFile(file.toString(), status.getLen(), header, blank)

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(first_line, found))


def read_files(
    spark: SparkSession,
    path: str,
    multiline: bool = False,
    split_above: int | None = None,
    block_bytes: int | None = None,
) -> DataFrame:
    """Every column as text, by the header of its own file, and ``MALFORMED``.

    Files with the same header are read together; others are united by name, so order
    and number of columns may differ from file to file. Comma, double quotes, an optional
    BOM. ``multiline`` allows line breaks inside quotes. A file of more than ``split_above`` bytes (a block, if not
    given) is then read by a task per block, see ``quoted_csv``, as are files that start with a blank line;
    smaller ones, and those whose quotes do not come in pairs, by one task each. ``block_bytes`` sets
    the size of a block.
    """
    groups: dict[tuple[str, ...], list[SourceFile]] = {}
    for file in _files(spark, path):
        groups.setdefault(file.header, []).append(file)
    if split_above is None:
        split_above = block_bytes or quoted_csv.session_block(spark)
    parts = []
    for columns, files in sorted(groups.items()):
        if len(set(columns)) < len(columns):
            raise ValueError(f"{files[0].name} names a column twice: {columns}")
        schema = T.StructType([T.StructField(name, T.StringType()) for name in (*columns, MALFORMED)])
        # Spark takes the first line for the header, blank or not; the records reader does not.
        large = [f.name for f in files if f.blank_start or (multiline and f.size > split_above)]
        if large:
            odd = quoted_csv.odd_files(spark, large)
            large = [name for name in large if name not in odd]
        small = [f.name for f in files if f.name not in set(large)]
        if large:
            parts.append(quoted_csv.read(spark, large, schema, MALFORMED, block_bytes))
        if small:
            part = spark.read.csv(
                small,
                schema=schema,
                header=True,
                quote='"',
                escape='"',
                multiLine=multiline,
                mode="PERMISSIVE",
                columnNameOfCorruptRecord=MALFORMED,
            )
            parts.append(part)
    if not parts:
        raise RuntimeError(f"{path} has no rows: check that the source was delivered")
    united = merge_drift(parts)
    return united.select(*[c for c in united.columns if c != MALFORMED], MALFORMED)


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The columns of ``read_files`` without the mark of malformed rows."""
    return read_files(spark, path, multiline).drop(MALFORMED)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Fail on an empty source; looks at one row instead of counting all."""
    if df.isEmpty():
        raise RuntimeError(f"{name} has no rows: check that the source was delivered")
    return df


def merge_drift(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column that only some parts have is null in the others."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def repair_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """Put columns that were split by type back under their contract name.

    A value lives in one of the split columns, so the first non-null one is
    taken. Only contract names are repaired: a real ``lead_int`` stays.
    """
    present = set(df.columns)
    split: dict[str, list[str]] = {}
    for name in contract.columns:
        variants = [f"{name}{s}" for s in TYPE_SUFFIXES if f"{name}{s}" in present]
        variants = [v for v in variants if v not in contract.columns]
        if variants:
            split[name] = ([name] if name in present else []) + variants
    gone = {c for group in split.values() for c in group}
    repaired: list[Column] = []
    placed = set()
    for column in df.columns:
        if column not in gone:
            repaired.append(F.col(column))
            continue
        name = next(n for n, group in split.items() if column in group)
        if name not in placed:
            placed.add(name)
            values = [_variant(c, contract.spark_type(name)) for c in split[name]]
            repaired.append(F.coalesce(*values).alias(name))
    return df.select(*repaired)


def _variant(column: str, kind: str) -> Column:
    """The text of a split column's value; a whole double of an int column without '.0'."""
    text = F.col(column).cast("string")
    if kind in ("int", "bigint") and column.endswith("_double"):
        number = text.try_cast("double")
        whole = number == F.floor(number)
        return F.when(whole, number.cast("bigint").cast("string")).otherwise(text)
    return text


def drop_all_null(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Drop columns without a single value; also says which ones. One pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    empty = [c for c in df.columns if counts[c] == 0]
    return df.drop(*empty), empty


def _is_unparsed(column: str) -> Column:
    return F.col(column).isNotNull() & parse_timestamp(F.col(column).cast("string")).isNull()


def add_partition_columns(df: DataFrame, date_column: str) -> DataFrame:
    """Year ('yyyy') and month ('MM') of a text or timestamp column.

    Rows whose date cannot be read get null for both and land in the null
    partition; ``unparsed_rows`` counts them.
    """
    column = date_column
    if column not in df.columns:
        column = f"{date_column}_string"
    if column not in df.columns:
        raise ValueError(f"cannot partition: no {date_column} among {df.columns}")
    parsed = parse_timestamp(F.col(column).cast("string"))
    year, month = F.year(parsed), F.month(parsed)
    # A formatter per row costs more than the parsing; only years of other than four digits need it.
    plain = F.when(year.between(1, 9999), F.lpad(year.cast("string"), 4, "0"))
    return df.withColumns(
        {
            "partition_year": plain.otherwise(F.date_format(parsed, "yyyy")),
            "partition_month": F.lpad(month.cast("string"), 2, "0"),
        }
    )


def drop_partition_columns(df: DataFrame) -> DataFrame:
    return df.drop(*PARTITION_COLUMNS)


def cast_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Parse the listed columns that exist; what cannot be read becomes null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: parse_timestamp(F.col(c).cast("string")) for c in present})


def timestamp_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values per column that are present but no timestamp: one pass for all columns."""
    present = [c for c in columns if c in df.columns]
    counted = df.agg(*[F.count(F.when(_is_unparsed(c), 1)).alias(c) for c in present])
    return counted.unpivot([], present, "column_name", "unparsed_rows")


def observed_timestamps(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``cast_timestamps`` with the counts of ``observed_failures``, each value parsed once; adds a column
    per timestamp that ``apply_contract`` drops."""
    present = [c for c in columns if c in df.columns]
    parsed = {c: parse_timestamp(F.col(c).cast("string")) for c in present}
    # The parsed value is asked first, so that it is a common part of both columns.
    unread = {f"_unread_{c}": parsed[c].isNull() & F.col(c).isNotNull() for c in present}
    counts = [F.count(F.when(F.col(f"_unread_{c}"), 1)).alias(f"unparsed_{c}") for c in present]
    seen = Observation()
    cast = df.withColumns(parsed | unread) if present else df
    return cast.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def observed_failures(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Observation]:
    """The same counts, filled in when ``df`` is written: no pass of their own."""
    seen = Observation()
    counts = [
        F.count(F.when(_is_unparsed(c), 1)).alias(f"unparsed_{c}")
        for c in columns
        if c in df.columns
    ]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def apply_contract(
    df: DataFrame, contract: Contract, all_null: Sequence[str] = ()
) -> DataFrame:
    """Exactly the contract's columns, in its order and with its types.

    Extra columns are dropped. A missing column is an error, unless it was
    dropped for being all null (``all_null``): that one returns as typed nulls.
    A value that does not fit its type stops the load.
    """
    missing = [c for c in contract.columns if c not in df.columns and c not in all_null]
    if missing:
        raise ValueError(f"required columns missing: {missing}; available: {df.columns}")
    values = {c: F.col(c) if c in df.columns else F.lit(None) for c in contract.columns}
    return df.select(*[v.cast(contract.spark_type(c)).alias(c) for c, v in values.items()])


def _broken(contract: Contract) -> dict[str, Column]:
    """What breaks the contract, as a test of a row."""
    tests = {f"{c} is longer than {n}": F.length(c) > n for c, n in contract.lengths.items()}
    if contract.required:
        tests[f"{contract.required} is null"] = F.col(contract.required).isNull()
    return tests


def observed_violations(df: DataFrame, contract: Contract) -> tuple[DataFrame, Observation]:
    """Counts of broken rules by their description, filled in when ``df`` is written."""
    seen = Observation()
    counts = [F.count(F.when(test, 1)).alias(name) for name, test in _broken(contract).items()]
    return (df.observe(seen, *counts) if counts else df), seen


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Values too long for their column, and nulls in the required one. One pass."""
    tests = _broken(contract) or {"no test": F.lit(False)}
    names = list(tests)
    counted = df.agg(*[F.count(F.when(tests[n], 1)).alias(f"v{i}") for i, n in enumerate(names)])
    rows = [
        F.struct(F.lit(n).alias("violation"), F.col(f"v{i}").alias("row_count"))
        for i, n in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*rows)))
