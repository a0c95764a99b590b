"""Mix sources to target weights, with built-in functions only.

Every document has a pseudo-random key, the MD5 of its doc_id. Within a source, documents
are ordered by key: the leading digits of the key cut the order into ranges of equal
expected size, the sizes of ranges are summed first, and only within a range rows are
sorted. A source's target is cut at the exact word; a target above the source's own size
repeats the source in whole epochs first.

Defined results: a null text has size 0; a source without words has target 0 and gives
nothing. The null source is a source of its own, after all others. Rows that repeat a
doc_id follow one another by size; a null doc_id counts as an empty string. Other columns
are ignored by ``mix`` and carried by ``draw``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.llm.common import SPACED_WORD, free_name, stage

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
RANGE_DIGITS = 4
"""Hex digits of the key that name a range: 65,536 ranges per source."""


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACED_WORD)).cast("bigint")


def random_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")))


def targets(sizes: DataFrame, weights: Sequence[int], most_epochs: int) -> DataFrame:
    """One row per source of ``sizes`` (source, source_size): its number and its target.

    The common level of words per weight is found by filling: sources ordered by the
    level at which they are exhausted stop there as long as the level of all later ones
    is at least as high. One row per source meets in one task, however many documents.
    """
    listed = F.array(*[F.lit(w).cast("bigint") for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sizes.withColumn("source_no", F.row_number().over(by_name)).select(
        "source",
        "source_no",
        "source_size",
        F.element_at(listed, ((F.col("source_no") - 1) % len(weights) + 1).cast("int")).alias("w"),
        (F.col("source_size") * most_epochs).alias("most"),
    )
    by_level = Window.orderBy(F.col("most") / F.col("w"), "source_no")
    whole = Window.partitionBy(F.lit(1))
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    later = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    pool = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(earlier), F.lit(0))
    stops = F.col("most") * F.sum("w").over(later) <= pool * F.col("w")
    filled = numbered.withColumn("stops", stops)
    left = F.sum("source_size").over(whole) - F.sum(F.when(F.col("stops"), F.col("most")).otherwise(0)).over(whole)
    weight_left = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("w"))).over(whole)
    share = (left * F.col("w")).cast("double") / weight_left.cast("double")
    return filled.select(
        "source",
        "source_no",
        "source_size",
        F.when(F.col("stops"), F.col("most").cast("double")).otherwise(share).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: str = "mix",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row of ``docs``: doc_id, source, key, size, source_size, target, taken.

    ``keep`` names further columns to carry along.
    """
    sized = stage(
        docs.select(
            *keep,
            "doc_id",
            "source",
            random_key(F.col("doc_id"), seed).alias("key"),
            n_words(F.col("text")).alias("size"),
        ),
        "sizes",
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stage(targets(per_source, weights, most_epochs), "targets")
    named = plan.withColumnRenamed("source", "plan_source")
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    rows = rows.withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    ranges = rows.groupBy("source_no", "range").agg(F.sum("size").alias("range_size"))
    up_to_range = (
        Window.partitionBy("source_no").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = ranges.select(
        "source_no", "range", F.sum("range_size").over(up_to_range).alias("range_start")
    )
    in_range = (
        Window.partitionBy("source_no", "range")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("before", F.sum("size").over(in_range)).join(
        offsets, ["source_no", "range"]
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    placed = placed.withColumn("epochs", epochs.cast("bigint"))
    cut = budget - F.col("epochs") * F.col("source_size")
    start = F.coalesce("range_start", F.lit(0)) + F.coalesce("before", F.lit(0))
    part = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), cut - start))
    return placed.select(
        *keep,
        "doc_id",
        "source",
        "key",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + part).cast("bigint").alias("taken"),
    )


def draw(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """The mixed rows, with the columns of ``docs``: a document once per epoch that takes it, whole.

    The one document of a source that the budget cuts is in its last epoch or not, by which comes nearer to the
    budget; so a source misses its budget by half a document at most. A document without words belongs
    to no epoch. Rows that agree in doc_id, source and text are one document, whose words count
    once per row; any one of them is repeated.
    """
    row, number = free_name(docs, "row"), free_name(docs, "copy")
    identity = F.struct("doc_id", "source", F.md5(F.coalesce("text", F.lit(""))))
    taken = (
        mix(docs.withColumn(row, identity), weights, most_epochs, seed, keep=[row])
        .groupBy(F.col(row).alias("row"))
        .agg(F.sum("taken").alias("taken"), F.max("size").alias("size"))
        .where("2 * taken >= size and taken > 0")
    )
    taken = taken.select(*[F.col(c).alias(free_name(docs, f"of_{c}")) for c in taken.columns])
    of_row, of_taken, of_size = taken.columns
    times = F.expr(f"sequence(1, (2 * {of_taken} + {of_size}) div (2 * {of_size}))")
    rows = docs.withColumn(row, identity).dropDuplicates([row]).join(taken, F.col(row) == F.col(of_row))
    return rows.withColumn(number, F.explode(times)).select(*[F.col(f"`{c}`") for c in docs.columns])
