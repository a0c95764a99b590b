"""A registered query: the Spark build, its columns, and the DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercatura.plans.models import Models
from mercatura.sources.marketplace import Marketplace
from oracles.duck import query

REGISTRY: dict[str, Entry] = {}

_TYPES = {"i": "bigint", "d": "double", "s": "string", "t": "timestamp_ntz", "b": "boolean"}


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def portable(df: DataFrame, columns: str) -> DataFrame:
    """The listed columns in types that compare alike on both sides."""
    pairs = [part.split() for part in columns.split(",")]
    return df.select(*[F.col(c).cast(_TYPES[kind]).alias(c) for c, kind in pairs])


def register(
    name: str, columns: str, build: Callable[[Models], DataFrame], sql: str | None = None
) -> None:
    """Register ``build`` under ``name``.

    ``columns`` lists the result's columns and types (see ``oracles.duck.query``);
    both sides are cast to them, so decimals and small ints compare alike.
    """

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(build(Models(Marketplace(spark, folder))), columns)

    if name in REGISTRY:
        raise ValueError(f"{name} is registered twice")
    REGISTRY[name] = Entry(run, None if sql is None else query(sql, columns))
