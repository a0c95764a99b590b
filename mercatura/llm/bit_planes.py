"""Centroid clustering of whole-number vectors by bit planes, with exact distances.

A vector of 64 whole numbers is kept as one 64-bit word per binary digit: bit i of plane k
is digit k of component i, in two's complement. A dot product is then a sum over pairs of
planes of 2^(j+k) times the number of bits set in both, the top digit weighing negative. All
sums are exact, so the clusters do not depend on how the rows are dealt to tasks.

The planes are staged once; a round reads them, and a task returns the count and the sums of its
vectors per cluster, again from planes. The driver holds the centroids only.

Defined results: vectors that are null, do not have exactly 64 components, or hold a null or
non-finite one take no part. Rows that repeat an id are vectors of their own. A row without an id
starts as a centroid only where too few rows have one; ties between starting rows go to the smaller
components. Fewer vectors than centroids make fewer centroids; no vectors give no rows. A centroid
without vectors stays where it is. Components whose whole numbers need more than ``MOST_PLANES`` digits
raise an error, as their distances would not fit a long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.llm.common import stage

DIMENSIONS = 64
MOST_PLANES = 28
BATCH_ROWS = 4_096


def takes_part(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vector.isNotNull() & (F.size(vector) == DIMENSIONS) & finite


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))


def digits(least: int, most: int) -> int:
    """Binary digits that two's complement takes for all numbers from ``least`` to ``most``."""
    return max(most.bit_length(), (-least - 1).bit_length() if least < 0 else 0) + 1


def planes(numbers: np.ndarray, count: int) -> np.ndarray:
    """(n, count) words of the rows (n, 64) of whole numbers, least digit first."""
    bits = (numbers[:, None, :] >> np.arange(count)[None, :, None]) & 1
    packed = np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")
    return packed.view("<u8").reshape(len(numbers), count)


def weights(count: int) -> np.ndarray:
    """What a bit of each plane stands for: powers of two, the last one negative."""
    out = np.int64(1) << np.arange(count, dtype=np.int64)
    out[-1] = -out[-1]
    return out


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of planes (n, p) with planes (m, p): weighted counts of common bits."""
    weight = weights(a.shape[1])
    out = np.zeros((len(a), len(b)), np.int64)
    for j, w in enumerate(weight.tolist()):
        common = np.bitwise_count(a[:, None, :] & b[None, :, j : j + 1]).astype(np.int64)
        out += w * (common @ weight)
    return out


def squares(a: np.ndarray) -> np.ndarray:
    """Squared lengths of planes (n, p)."""
    weight = weights(a.shape[1])
    common = np.bitwise_count(a[:, :, None] & a[:, None, :]).astype(np.int64)
    return (common @ weight) @ weight


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid of each vector, all as planes;
    ties go to the smaller number."""
    far = squares(vectors)[:, None] + squares(centroids)[None, :] - 2 * dots(vectors, centroids)
    cluster = far.argmin(axis=1)
    return cluster, far[np.arange(len(far)), cluster]


def component_sums(vectors: np.ndarray) -> np.ndarray:
    """The 64 sums of the components of planes (n, p)."""
    bits = np.unpackbits(np.ascontiguousarray(vectors).view(np.uint8), axis=1, bitorder="little")
    per_bit = bits.sum(axis=0, dtype=np.int64).reshape(vectors.shape[1], DIMENSIONS)
    return weights(vectors.shape[1]) @ per_bit


def _read(batch: pa.RecordBatch, count: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("planes"))
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, count)


@dataclass(frozen=True)
class Planes:
    """A table staged as planes: ``rows`` (vec_id, planes) of ``count`` words each, and the
    whole numbers the centroids start from."""

    rows: DataFrame
    count: int
    seeds: list[list[int]]


def to_planes(vectors: DataFrame, scale: int, clusters: int, seed: str) -> Planes | None:
    """The vectors of a table (vec_id, embedding) as planes; None if none takes part."""
    numbers = vectors.where(takes_part(F.col("embedding"))).select(
        "vec_id", whole_numbers(F.col("embedding"), scale).alias("numbers")
    )
    least, most = numbers.agg(F.min(F.array_min("numbers")), F.max(F.array_max("numbers"))).first()
    if least is None:
        return None
    count = digits(least, most)
    if count > MOST_PLANES:
        raise ValueError(f"components from {least} to {most} take {count} digits, of {MOST_PLANES} at most")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = numbers.orderBy(order.asc_nulls_last(), "numbers").limit(clusters)
    seeds = [list(r.numbers) for r in first.collect()]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                found = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                words = planes(found.reshape(-1, DIMENSIONS), count).view(np.int64)
                offsets = np.arange(0, words.size + 1, count, dtype=np.int32)
                lists = pa.ListArray.from_arrays(offsets, words.ravel())
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["vec_id", "planes"])

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    packed = numbers.mapInArrow(pack, f"vec_id {id_type}, planes array<bigint>")
    return Planes(stage(packed, "planes"), count, seeds)


def _sums(table: Planes, centroids: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """Cluster, count and component sums of every cluster that has vectors."""
    count = table.count

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), DIMENSIONS), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                vectors = _read(whole.slice(at, BATCH_ROWS), count)
                cluster, _ = nearest(vectors, centroids)
                for c in np.unique(cluster):
                    members = vectors[cluster == c]
                    sizes[c] += len(members)
                    sums[c] += component_sums(members)
        used = np.flatnonzero(sizes)
        offsets = np.arange(0, len(used) * DIMENSIONS + 1, DIMENSIONS, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used.astype(np.int32)),
                pa.array(sizes[used]),
                pa.ListArray.from_arrays(offsets, sums[used].ravel()),
            ],
            ["cluster", "size", "sums"],
        )

    parts = table.rows.select("planes").mapInArrow(add, "cluster int, size bigint, sums array<bigint>")
    total = [F.sum(F.col("sums")[i]) for i in range(DIMENSIONS)]
    met = parts.groupBy("cluster").agg(F.sum("size").alias("size"), F.array(*total).alias("sums"))
    return [(r.cluster, r["size"], list(r.sums)) for r in met.collect()]


def cluster(
    vectors: DataFrame, clusters: int = 8, rounds: int = 10, scale: int = 1024, seed: str = "3"
) -> DataFrame:
    """Per vector of a table (vec_id, embedding) that takes part: vec_id, cluster, distance (squared) and
    centroid, the whole numbers of its cluster's final centroid."""
    spark = vectors.sparkSession
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, cluster int, distance bigint"
    table = to_planes(vectors, scale, clusters, seed)
    if table is None:
        return spark.createDataFrame([], f"{schema}, centroid array<bigint>")
    numbers, count = [list(s) for s in table.seeds], table.count
    for _ in range(rounds):
        centroids = planes(np.array(numbers, np.int64), count)
        for at, size, sums in _sums(table, centroids):
            numbers[at] = [s // size for s in sums]
    centroids = planes(np.array(numbers, np.int64), count)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                found, distance = nearest(_read(batch, count), centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

    assigned = stage(table.rows.mapInArrow(assign, schema), "assigned")
    named = F.element_at(
        F.array(*[F.array(*[F.lit(x).cast("bigint") for x in c]) for c in numbers]), F.col("cluster") + 1
    )
    return assigned.withColumn("centroid", named)


def inertia(assigned: DataFrame) -> DataFrame:
    """The rows of ``cluster`` with cluster_inertia, the sum of the distances in a row's cluster, and
    inertia, that of all. One row per cluster meets in the driver."""
    met = assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()
    per_cluster = {r["cluster"]: r["total"] for r in met}
    of = F.lit(None).cast("bigint")
    for number, total in sorted(per_cluster.items()):
        of = F.when(F.col("cluster") == number, F.lit(total).cast("bigint")).otherwise(of)
    whole = F.lit(sum(per_cluster.values())).cast("bigint")
    return assigned.withColumn("cluster_inertia", of).withColumn("inertia", whole)
