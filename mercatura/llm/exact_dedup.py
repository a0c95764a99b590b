"""Exact duplicates with a heavy-hitter split.

Misra-Gries summaries of the text digests find the digests that may be frequent. Their
exact counts and winners, at most ``slots`` rows, are broadcast, so rows of a frequent
text are settled where they are read. All other digests go through a shuffle in which
none of them can hold more than a share of 1 / ``slots`` of the rows.

Defined results: a null text counts as empty, empty texts equal one another. A null doc_id
is below every other; among rows without any doc_id the kept one has none. Rows that
repeat doc_id and text share the decision, and ``keep_one`` leaves one of them. Extra
columns of any name stay as they are. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.llm.common import ascii_lower, free_name, stage

SLOTS = 1024
"""Counters of a summary and upper bound of the broadcast winners."""

_WINNERS = "digest binary, keep_id bigint, group_size bigint"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A to Z in lower case."""
    return F.unhex(F.sha2(ascii_lower(text), 256))


def prune(counts: dict[bytes, int], slots: int) -> dict[bytes, int]:
    """The Misra-Gries step: lower all counters until at most ``slots`` are above zero.

    A value seen more often than 1 / (slots + 1) of all rows keeps a counter.
    """
    if len(counts) <= slots:
        return counts
    floor = sorted(counts.values(), reverse=True)[slots]
    return {value: n - floor for value, n in counts.items() if n > floor}


def summarise(digests: DataFrame, slots: int) -> DataFrame:
    """One Misra-Gries summary of ``digest`` per partition: (digest, n)."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            seen = pc.value_counts(batch.column(0))
            pairs = zip(seen.field(0).to_pylist(), seen.field(1).to_pylist())
            for value, n in pairs:
                counts[value] = counts.get(value, 0) + n
            counts = prune(counts, slots)
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
            ["digest", "n"],
        )

    return digests.select("digest").mapInArrow(summary, "digest binary, n bigint")


def frequent(digests: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Verified frequent digests with winner and exact count: at most ``slots`` rows."""
    spark = digests.sparkSession
    merged = (
        summarise(digests, slots)
        .groupBy("digest")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "digest")
        .limit(slots + 1)
        .collect()
    )
    kept = prune({bytes(row.digest): row.n for row in merged}, slots)
    candidates = spark.createDataFrame([(digest,) for digest in kept], "digest binary")
    exact = (
        digests.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .collect()
    )
    rows = [(bytes(r.digest), r.keep_id, r.group_size) for r in exact]
    return spark.createDataFrame(rows, _WINNERS)


def _groups(digests: DataFrame, slots: int) -> tuple[DataFrame, DataFrame]:
    """Winners of the frequent digests, and winners of all the others."""
    hot = frequent(digests, slots)
    rest = (
        digests.join(F.broadcast(hot), "digest", "left_anti")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return hot, rest


def find_groups(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, digest."""
    digests = stage(docs.select("doc_id", text_digest(F.col("text")).alias("digest")), "digests")
    hot, rest = _groups(digests, slots)
    settled = digests.join(F.broadcast(hot), "digest")
    others = digests.join(F.broadcast(hot), "digest", "left_anti").join(rest, "digest")
    return settled.unionByName(others).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
    )


def keep_one(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the largest doc_id."""
    digests = stage(docs.select("doc_id", text_digest(F.col("text")).alias("digest")), "digests")
    hot, rest = _groups(digests, slots)
    key, keep = free_name(docs, "digest"), free_name(docs, "keep_id")
    hot, rest = (t.select(F.col("digest").alias(key), F.col("keep_id").alias(keep)) for t in (hot, rest))
    rows = docs.withColumn(key, text_digest(F.col("text")))
    wins = F.col("doc_id").eqNullSafe(F.col(keep))
    settled = rows.join(F.broadcast(hot), key).where(wins)
    others = rows.join(F.broadcast(hot), key, "left_anti").join(rest, key).where(wins)
    return (
        settled.dropDuplicates([key])
        .unionByName(others.dropDuplicates([key]))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
