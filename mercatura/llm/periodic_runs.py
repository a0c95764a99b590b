"""Maximal periodic runs of words, found through a dictionary of basic factors.

The stretches of 2^k words of a text get names, equal ones the same, from pairs of names of
half their length. For each length, the next occurrence of every stretch is looked up, and kept
if both fit a window of twice the length, so its distance is at most the length. Distances that repeat
one period further on are an arithmetic progression of occurrences and propose that distance as a
period. A proposal is extended over all adjacent places of the same distance; by the periodicity lemma
this gives the whole run, and the distance is its smallest period. A run proposed at
several lengths is kept once.

Texts are worked on many at a time, each in its own row's task: nothing is shuffled, and
no text is cut. A stretch that does not repeat is not named any further, so ordinary prose is
done after a few lengths.

Defined results: a null, empty or blank text has no words, no runs and an empty collapsed text.
Rows are independent: ids may be null or repeat, and other columns are ignored, whatever their names. Memory
grows with a batch of a few MB or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.llm.word_hash import chunks

LEAST_WORDS = 6
LEAST_EXPONENT = 4
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and where each text's words start, with the end of the last.
    Words end at ASCII white space."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    real = pc.not_equal(words, "")
    ends = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return words.filter(real), ends[bounds]


def _named(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places ``at`` whose key occurs again, ordered by key and place; their names; and the distance
    of each to the next one of its name, 0 for none."""
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    same = keys[1:] == keys[:-1]
    again = np.zeros(len(keys), bool)
    again[1:] = same
    again[:-1] |= same
    starts = np.ones(len(keys), bool)
    starts[1:] = ~same
    distance = np.zeros(len(keys), np.int64)
    distance[:-1] = np.where(same, at[1:] - at[:-1], 0)
    return at[again], (np.cumsum(starts) - 1)[again], distance[again]


def find_runs(
    codes: np.ndarray, bounds: np.ndarray, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT
) -> np.ndarray:
    """Runs (start, length, period) of sequences laid end to end, by start, then period.

    ``codes`` number the words, ``bounds`` say where each sequence starts, and the end of
    the last. A run has at least ``least`` words and ``exponent`` (4 or more) periods: then stretches of
    the first power of two that is no shorter than its period occur in it three times in progression.
    """
    if exponent < 4:
        raise ValueError("runs of fewer than four periods may hold no progression")
    total = len(codes)
    sequence = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    ends = np.repeat(bounds[1:], np.diff(bounds))
    keys = sequence * (int(codes.max(initial=0)) + 1) + codes
    at, names, distance = _named(keys, np.arange(total))
    found = []
    length = 1
    while len(at):
        near = np.zeros(total, np.int64)
        near[at] = np.where(distance <= length, distance, 0)
        # Places with the same distance one period on: three occurrences in progression.
        heads = np.flatnonzero(near)
        onward = heads + near[heads]
        heads = heads[near[onward] == near[heads]]
        if len(heads):
            changes = np.flatnonzero(np.diff(near)) + 1
            stretch = np.unique(np.searchsorted(changes, heads, "right"))
            edges = np.concatenate([[0], changes, [total]])
            start, stop = edges[stretch], edges[stretch + 1]
            period = near[start]
            words = stop - start + length - 1 + period
            whole = (words >= least) & (words >= exponent * period)
            found.append(np.column_stack([start, words, period])[whole])
        name_at = np.full(total, -1, np.int64)
        name_at[at] = names
        at = np.flatnonzero(name_at >= 0)
        at = at[at + 2 * length <= ends[at]]
        at = at[name_at[at + length] >= 0]
        keys = name_at[at] * (int(names.max()) + 1) + name_at[at + length]
        at, names, distance = _named(keys, at)
        length *= 2
    if not found:
        return np.empty((0, 3), np.int64)
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def repeated_words(runs: np.ndarray, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a run after its first period."""
    edges = np.zeros(total + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:-1]) > 0


def _columns(texts: pa.Array) -> list[pa.Array]:
    """n_words, runs and collapsed of some texts."""
    words, bounds = split_words(texts)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    runs = find_runs(codes, bounds)
    of = np.searchsorted(bounds, runs[:, 0], "right") - 1
    firsts = np.searchsorted(of, np.arange(len(bounds))).astype(np.int32)
    fields = [runs[:, 0] - bounds[of], runs[:, 1], runs[:, 2]]
    structs = pa.StructArray.from_arrays([pa.array(f) for f in fields], ["start", "length", "period"])
    kept = ~repeated_words(runs, len(words))
    offsets = np.concatenate([[0], np.cumsum(kept)])[bounds].astype(np.int32)
    collapsed = pc.binary_join(pa.ListArray.from_arrays(offsets, words.filter(pa.array(kept))), " ")
    return [pa.array(np.diff(bounds)), pa.ListArray.from_arrays(firsts, structs), collapsed]


def runs_of(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, runs (start, length and period, by start,
    then period) and collapsed, the words outside of runs and each run's first period, joined by a space."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in chunks(batch.column(1)):
                ids = batch.column(0).slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [ids, *_columns(texts)], ["doc_id", "n_words", "runs", "collapsed"]
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words bigint, runs array<{RUN}>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def with_period(words: Column, start: Column, period: Column) -> Column:
    """``words`` with every word from ``start`` on replaced by that of its place modulo ``period``."""
    place = lambda i: F.when(i >= start, start + (i - start) % period).otherwise(i)
    return F.transform(words, lambda _, i: F.get(words, place(i).cast("int")))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by the CRC-32 of its id, gets a periodic end. A row without an
    id is left as it is."""
    spread = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", spread.alias("spread")).withColumn(
        "words",
        F.when(
            F.col("spread") % 10 == 0,
            F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)),
        ),
    )
    part, count = F.floor(F.col("spread") / 10), F.size("words")
    placed = chosen.withColumn("start", F.when(count > 0, part % count)).withColumn(
        "period", 1 + F.floor((F.size("words") - F.col("start")) / (3 + part % 8))
    )
    edited = F.array_join(with_period(F.col("words"), F.col("start"), F.col("period")), " ")
    return placed.select("doc_id", F.when(F.col("start").isNotNull(), edited).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """One row per row of ``runs_of``: the run of the greatest exponent, and digests."""
    first = F.array_sort(
        "runs",
        lambda a, b: F.when(a.length * b.period != b.length * a.period,
                            F.when(a.length * b.period > b.length * a.period, -1).otherwise(1))
        .when(a.start != b.start, F.when(a.start < b.start, -1).otherwise(1))
        .otherwise(F.when(a.period < b.period, -1).when(a.period > b.period, 1).otherwise(0)),
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    best = found.withColumn("best", F.get(first, F.lit(0)))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
