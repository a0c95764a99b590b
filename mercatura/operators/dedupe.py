"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key under ``order``.

    The rank is only compared with 1, so Spark cuts each map task down to one row
    per key before the shuffle (WindowGroupLimit): a key with a third of all rows
    still ships one row per task.
    """
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def mark_first_copy(
    df: DataFrame, key: str, name: str, order: Sequence[Column] | None = None
) -> DataFrame:
    """The rows that have a key, with a flag that is true for one row of each, the first by ``order`` if given.

    The sum of the flags is the number of different keys, also after joins by the key that multiply
    no row. The rows are dealt and sorted by the key, as a join by it needs them anyway.
    """
    copies = Window.partitionBy(key).orderBy(*(order or [key]))
    return df.where(F.col(key).isNotNull()).withColumn(name, F.row_number().over(copies) == 1)
