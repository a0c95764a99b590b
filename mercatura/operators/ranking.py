"""Whole-table and per-key ranks that never put one group into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.session import stage

# monotonically_increasing_id is documented as partition id in the upper bits and
# row number within the partition in the lower 33.
_ROW_BITS = 33


@dataclass(frozen=True)
class Tiles:
    """``tiles`` equal shares of the table in the order of ``order``."""

    order: Sequence[Column]
    tiles: int


def with_tiles(df: DataFrame, id_column: str, tiles: Mapping[str, Tiles]) -> DataFrame:
    """Add one ntile column per entry, without a single-partition window.

    For every entry the rows are sorted globally (range shuffle; the id is part of
    the sort key, so equal values spread over partitions) and numbered inside
    their partition. The numbers are fixed by staging the rows once. A row's
    place in the whole table is then its number plus the sizes of the partitions
    before it, and the tile follows from the place by arithmetic.
    """
    numbered = df
    for name, spec in tiles.items():
        numbered = numbered.orderBy(*spec.order, F.col(id_column)).withColumn(
            f"_at_{name}", F.monotonically_increasing_id()
        )
    numbered = stage(numbered, "ranked")

    result = numbered
    for name, spec in tiles.items():
        at = F.col(f"_at_{name}")
        part = F.shiftright(at, _ROW_BITS)
        # One row per range partition of the sort, so at most
        # spark.sql.shuffle.partitions rows: fits one task and a broadcast.
        sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
        by_part = Window.orderBy("_part")
        places = sizes.select(
            F.col("_part"),
            (F.sum("_size").over(by_part) - F.col("_size")).alias("_before"),
            F.sum("_size").over(Window.partitionBy()).alias("_total"),
        )
        row = at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        result = (
            result.withColumn("_part", part)
            .join(F.broadcast(places), "_part")
            .withColumn(name, _tile(F.col("_before") + row, F.col("_total"), spec.tiles))
            .drop("_part", "_before", "_total", f"_at_{name}")
        )
    return result


def _tile(place: Column, total: Column, tiles: int) -> Column:
    """Tile of the row at 0-based ``place``; the first ``total % tiles`` are one larger."""
    small = F.floor(total / tiles)
    larger = total % tiles
    head = larger * (small + 1)
    return (
        F.when(place < head, F.floor(place / (small + 1)) + 1)
        .otherwise(larger + F.floor((place - head) / F.greatest(small, F.lit(1))) + 1)
        .cast("int")
    )


def sequence_per_key(
    df: DataFrame, key: str, ts: str, id_column: str, sequence: str, first_ts: str
) -> DataFrame:
    """Number the rows of each key by (ts, id) and add the key's first ts.

    The rows are sorted globally by (key, ts, id), so the rows of one key, even those of one
    instant, spread over as many partitions as they need, and staged with their place. A
    row's number is its place among the key's rows of its partition plus the
    key's rows in the partitions before: one row per key and partition is all that meets.

    The result has the columns id, key, ts, sequence and first_ts only.
    """
    placed = df.select(id_column, key, ts).orderBy(
        F.col(key), F.col(ts).asc_nulls_last(), F.col(id_column).asc_nulls_last()
    )
    placed = stage(placed.withColumn("_at", F.monotonically_increasing_id()), "sequenced")
    # Structs compare null-safe, so rows without a key stay in.
    run = F.struct(F.shiftright("_at", _ROW_BITS).alias("part"), F.col(key).alias("key"))
    placed = placed.withColumn("_run", run)
    runs = placed.groupBy("_run").agg(
        F.count(F.lit(1)).alias("_size"), F.min("_at").alias("_start"), F.min(ts).alias("_first")
    )
    in_key = Window.partitionBy(F.col("_run.key"))
    so_far = in_key.orderBy("_run.part").rowsBetween(Window.unboundedPreceding, -1)
    carried = runs.select(
        "_run",
        (F.col("_start") - F.coalesce(F.sum("_size").over(so_far), F.lit(0))).alias("_zero"),
        F.min("_first").over(in_key).alias(first_ts),
    )
    return placed.join(carried, "_run").select(
        id_column, key, ts, (F.col("_at") - F.col("_zero") + 1).alias(sequence), first_ts
    )
