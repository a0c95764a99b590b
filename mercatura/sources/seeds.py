"""The category translation seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercatura.sources.contracts import CONTRACTS
from mercatura.sources.raw_csv import apply_contract, read_csv, require_rows


def load_translation(spark: SparkSession, path: str) -> DataFrame:
    """The seed file, about 70 rows with a BOM and CRLF line ends."""
    seed = require_rows(read_csv(spark, path), path)
    return apply_contract(seed, CONTRACTS["category_translation"])
