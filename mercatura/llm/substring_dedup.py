"""Repeated passages: winnowed seeds, extended both ways to maximal repeats.

Every window of ``length`` words has an anchor, the smallest hash among its shingles of
``seed`` words; equal windows have equal anchors, and a text has about one anchor per four
words. Documents meet on their anchors, and anchors of one document only, most of them, end
there. A shared anchor is a seed: the windows that it anchors reach from it as far
as ``length - seed`` words to either side. These are hashed and meet in turn, which gives the
smallest document of each. Windows that an earlier document has, where they overlap or
touch, make a maximal repeat of ``length`` words or more, and its words go.

Per anchor and per window, only the smallest and largest doc_id are gathered, combined
before rows are moved, and joined back: a passage that a third of all documents share costs
one row per document, not one per pair. Texts are moved by doc_id only.

Windows are compared by 96 bits of hashes.

Defined results: words are split at ASCII white space; texts with fewer words than a window, empty
and null ones lose nothing. A row without doc_id is no earlier document and loses nothing.
Rows with equal doc_id are not earlier than one another. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.llm.common import drop_staged_table, stage
from mercatura.llm.word_hash import chunks, mix, word_hashes

LENGTH = 13
SEED = 7

_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def rolled(hashes: np.ndarray, words: int, factor: np.uint64) -> np.ndarray:
    """A hash of every run of ``words`` words, by their hashes."""
    count = len(hashes) - words + 1
    if count <= 0:
        return hashes[:0]
    out = np.zeros(count, np.uint64)
    for shift in range(words):
        out = out * factor + hashes[shift : shift + count]
    return mix(out)


class Windows:
    """The windows of one text: hash, second hash, anchor."""

    def __init__(self, hashes: np.ndarray, length: int, seed: int) -> None:
        self.first = rolled(hashes, length, _FACTORS[0]).view(np.int64)
        self.second = rolled(hashes, length, _FACTORS[1]).view(np.int64).astype(np.int32)
        shingles = rolled(hashes, seed, _FACTORS[0]).view(np.int64)
        if len(self.first):
            around = np.lib.stride_tricks.sliding_window_view(shingles, length - seed + 1)
            self.anchor = around.min(axis=1)
        else:
            self.anchor = self.first


def _each_text(texts: pa.Array) -> Iterator[np.ndarray]:
    for part in chunks(texts):
        hashes, bounds = word_hashes(part, lower=False)
        for start, end in zip(bounds[:-1], bounds[1:]):
            yield hashes[start:end]


def _flat(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.empty(0, kind.to_pandas_dtype())
    return pa.array(flat.astype(kind.to_pandas_dtype(), copy=False), kind)


def _anchors(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(doc_id, anchors): the distinct anchors of each document that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in chunks(batch.column(1)):
                found = [np.unique(Windows(h, length, seed).anchor) for h in _each_text(part)]
                ends = np.cumsum([0, *map(len, found)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _flat(found, pa.int64()))
                rows = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(found)), lists], ["doc_id", "anchors"]
                )
                done += len(found)
                yield rows.filter(pa.array(np.diff(ends) > 0))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, anchors array<bigint>")


def _seeded_windows(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(doc_id, first, second): windows whose anchor is in the row's ``anchors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in chunks(batch.column(1)):
                firsts, seconds, sizes = [], [], []
                for at, hashes in enumerate(_each_text(part), done):
                    windows = Windows(hashes, length, seed)
                    seeds = batch.column(2)[at].values.to_numpy()
                    chosen = np.flatnonzero(np.isin(windows.anchor, seeds))
                    _, once = np.unique(windows.first[chosen], return_index=True)
                    firsts.append(windows.first[chosen[once]])
                    seconds.append(windows.second[chosen[once]])
                    sizes.append(len(once))
                ids = batch.column(0).slice(done, len(sizes))
                of_doc = np.repeat(np.arange(len(sizes)), sizes)
                done += len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(of_doc)),
                        _flat(firsts, pa.int64()),
                        _flat(seconds, pa.int32()),
                    ],
                    ["doc_id", "first", "second"],
                )

    return docs.select("doc_id", "text", "anchors").mapInArrow(
        run, "doc_id bigint, first bigint, second int"
    )


def _shared(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys found in more than one document, with the smallest doc_id."""
    ends = rows.groupBy(*keys).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    return ends.where("low < high").drop("high")


def earlier_windows(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc_id, windows): hashes of the document's windows that an earlier document has."""
    named = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    anchored = stage(_anchors(named, length, seed), "anchored")
    anchors = anchored.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = stage(_shared(anchors, "anchor").drop("low"), "anchors")
    seeds = anchors.join(shared, "anchor").groupBy(F.col("doc_id").alias("seed_id"))
    seeds = stage(seeds.agg(F.collect_set("anchor").alias("anchors")), "seeds")
    drop_staged_table(anchored)
    seeded = named.join(seeds, F.col("doc_id") == F.col("seed_id"))
    windows = stage(_seeded_windows(seeded, length, seed), "windows")
    firsts = stage(_shared(windows, "first", "second"), "first-documents")
    hits = windows.join(firsts, ["first", "second"]).where("doc_id > low")
    hits = stage(hits.groupBy("doc_id").agg(F.collect_set("first").alias("windows")), "hits")
    drop_staged_table(windows)
    return hits


def _with_windows(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(doc_id, text, windows) of every row; rows without doc_id never meet the others."""
    hits = earlier_windows(docs, length, seed).withColumnRenamed("doc_id", "hit_id")
    rows = docs.select("doc_id", "text")
    named = rows.where("doc_id is not null").join(hits, F.col("doc_id") == F.col("hit_id"), "left")
    nameless = rows.where("doc_id is null").withColumn("windows", F.lit(None).cast("array<bigint>"))
    return named.drop("hit_id").unionByName(nameless)


def _covered(hashes: np.ndarray, hit: pa.Scalar, length: int, seed: int) -> np.ndarray:
    """Which words a hit window covers."""
    covered = np.zeros(len(hashes), bool)
    if hit.is_valid:
        first = rolled(hashes, length, _FACTORS[0]).view(np.int64)
        ends = np.zeros(len(hashes) + 1, np.int64)
        starts = np.flatnonzero(np.isin(first, hit.values.to_numpy()))
        ends[starts] += 1
        np.subtract.at(ends, starts + length, 1)
        covered = np.cumsum(ends)[:-1] > 0
    return covered


Describe = Callable[[str, np.ndarray], tuple]


def _describe(docs: DataFrame, length: int, seed: int, describe: Describe, names: str) -> DataFrame:
    """doc_id and what ``describe`` says of each text and its covered words."""
    columns = [part.strip().split(" ", 1) for part in names.split(";")]
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    kinds["array<struct<start_word:bigint,end_word:bigint>>"] = pa.list_(
        pa.struct([("start_word", pa.int64()), ("end_word", pa.int64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, hashes in enumerate(_each_text(batch.column(1))):
                covered = _covered(hashes, batch.column(2)[at], length, seed)
                rows.append(describe(batch.column(1)[at].as_py() or "", covered))
            made = [
                pa.array([row[i] for row in rows], kinds[kind]) for i, (_, kind) in enumerate(columns)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *made], ["doc_id", *[name for name, _ in columns]]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *[f"{name} {kind}" for name, kind in columns]])
    return _with_windows(docs, length, seed).mapInArrow(run, schema)


def find_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, repeats (maximal repeats as start_word, end_word)."""

    def describe(_: str, covered: np.ndarray) -> tuple:
        turns = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]])))
        pairs = turns.reshape(-1, 2).tolist()
        return ([{"start_word": start, "end_word": end} for start, end in pairs],)

    return _describe(
        docs, length, seed, describe, "repeats array<struct<start_word:bigint,end_word:bigint>>"
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept (the words left, one space between)."""

    def describe(text: str, covered: np.ndarray) -> tuple:
        words = text.encode().split()
        left = [w for w, gone in zip(words, covered.tolist()) if not gone]
        return len(words), len(words) - len(left), b" ".join(left).decode()

    return _describe(docs, length, seed, describe, "n_words bigint; n_removed bigint; kept string")


def digests(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """As ``remove_repeats``, with the SHA-256 of the words left instead of them."""

    def describe(text: str, covered: np.ndarray) -> tuple:
        words = text.encode().split()
        left = [w for w, gone in zip(words, covered.tolist()) if not gone]
        return len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()

    return _describe(docs, length, seed, describe, "n_words bigint; n_removed bigint; kept_sha256 string")
