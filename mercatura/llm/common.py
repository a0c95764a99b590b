"""What the operators share: staged tables, free column names, text forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercatura import session
from mercatura.session import shuffles_freed

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def small_batches(spark: SparkSession, rows: int = 2_000, size: str = "8m") -> None:
    """Hand rows to Python in batches of a few MB: with whole texts, the usual 10,000 rows are
    tens of MB in the JVM, in Arrow and in each worker at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """A table in the shared folder with the rows of ``df``; survives lost executors.

    Lineage ends here, and so do the shuffle files that made the rows.
    """
    with shuffles_freed(df.sparkSession):
        return session.stage(df, label, compression)


def drop_staged_table(staged: DataFrame) -> None:
    """Deletes the files of a staged table that nothing reads any more."""
    folders = {file.rsplit("/", 1)[0] for file in staged.inputFiles()}
    for folder in folders:
        session.drop_path(staged.sparkSession, folder)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores appended until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, every other character as it is; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")
