"""Near duplicates: banded MinHash candidates, odd sketches, sets compared in full.

A document is the set of its distinct word shingles. Equal sets are one node. MinHash
samples, cut into bands, put nodes that are likely similar into common buckets. All samples
are also folded into an odd sketch, a bitmap of parities: the bits in which two sketches
differ estimate the similarity, most precisely where it is high, and most false candidates
end there. Pairs that pass are compared on their full sets.

A bucket is not expanded into all its pairs. First every member meets one node of its
bucket, another one in each bucket. The links so found join most members of a large group. Only where members of one
bucket are still in different components, the pairs across components meet too, behind
sketches of many more samples. So no link that would join two components is skipped, and groups of
copies of any size cost about one comparison per member and band.

A large bucket of unlike documents, as a passage that many share makes it, is dealt anew by rare
shingles. Sets of similarity s have the share s of the larger one in common, so if each set is put in
one order, rare shingles first, the first ones of each, one more than the share 1 - s, have one in
common: these are the finer keys, and no link is lost. What many documents share comes last and is
no key. Rarity is told from a table of counts of a fixed size; any order is right.

Finer buckets are large where many sets are alike, about as much as is wanted. There each set is told by
what sets it apart from the centre of its group. Those near the centre are linked to one node; of the
others, two are similar only if enough of what sets them apart is common, and again the rarest first shingles
of that are keys. This too is exact, whatever the centre is, see ``around_hubs``.

With 48 bands of 6 samples a pair of similarity 0.8 has no common bucket with a probability of
about 5e-7; the sketch turns one away about six standard deviations below its similarity.

Defined results: words are split at ASCII white space after lowering A to Z; fewer words
than a shingle has are one shingle, none or a null text make an empty set, which is linked
with nothing and kept. Rows with equal doc_id are separate texts; the smallest doc_id of a
component names it, null ones aside. Other columns are ignored or carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.llm.common import free_name, small_batches, stage
from mercatura.llm.components import link_members, shared_buckets
from mercatura.llm.word_hash import chunks, mix, word_hashes

WORDS = 5
PERCENT = 80
BANDS, ROWS = 48, 6


class Sketch(NamedTuple):
    """An odd sketch: samples folded, bits, and how far below the wanted similarity its
    estimate may fall (six standard deviations or more)."""

    samples: int
    bits: int
    slack: float


COARSE = Sketch(BANDS * ROWS, 1024, 0.15)
"""Of every set, from the samples of its bands."""
FINE = Sketch(4096, 8192, 0.045)
"""Of sets that are in a bucket of several components."""

FINE_SETS = 128
"""Sets that are sketched finely at once."""
COUNTERS = 1 << 18
"""Counts of shingles, by their hashes, from which rare ones are told."""
BROADCAST_SHINGLES = 500_000
"""Most shingles (8 bytes each) of centres that are broadcast; more are shuffled."""

_ODD = np.uint64(0x9E3779B97F4A7C15)


@cache
def _constants(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts of ``count`` hash functions."""
    rng = np.random.default_rng(count)
    factors = rng.integers(0, 2**32, count, dtype=np.uint32) | np.uint32(1)
    return factors, rng.integers(0, 2**32, count, dtype=np.uint32)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    sets: list[np.ndarray] = []
    for part in chunks(texts):
        hashes, bounds = word_hashes(part)
        rolled = mix(hashes)
        for shift in range(1, words):
            rolled = mix(rolled[:-1] * _ODD + hashes[shift:]) if len(rolled) else rolled
        for start, end in zip(bounds[:-1], bounds[1:]):
            if end - start >= words:
                sets.append(np.unique(rolled[start : end - words + 1]))
            elif end > start:
                whole = hashlib.blake2b(hashes[start:end].tobytes(), digest_size=8).digest()
                sets.append(np.frombuffer(whole, np.uint64))
            else:
                sets.append(hashes[:0])
    return sets


def samples(sets: list[np.ndarray], count: int = COARSE.samples) -> np.ndarray:
    """MinHash samples of non-empty sets, one row per set."""
    factors, shifts = _constants(count)
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((count, len(sets)), np.uint32)
    for i in range(count):
        out[i] = np.minimum.reduceat(flat * factors[i] + shifts[i], starts)
    return out.T


def band_keys(sampled: np.ndarray) -> np.ndarray:
    """One 64-bit key per set and band; keys of different bands differ."""
    grouped = sampled.reshape(len(sampled), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), grouped.shape[:2])
    for row in range(ROWS):
        keys = mix(keys * _ODD + grouped[:, :, row])
    return keys.view(np.int64)


def odd_sketches(sampled: np.ndarray, bits: int = COARSE.bits) -> np.ndarray:
    """Parities of the samples' places in a bitmap: one row of 64-bit words per set."""
    count = sampled.shape[1]
    numbered = sampled.astype(np.uint64) | (np.arange(count, dtype=np.uint64) << np.uint64(32))
    places = (mix(numbered * _ODD) >> np.uint64(20)) % np.uint64(bits)
    at = places.astype(np.int64) + np.arange(len(sampled))[:, None] * bits
    parity = np.bincount(at.ravel(), minlength=len(sampled) * bits) & 1
    return np.packbits(parity.astype(np.uint8).reshape(len(sampled), -1), axis=1).view(np.int64)


def most_differing(percent: int, kind: Sketch = COARSE) -> int:
    """The number of differing sketch bits at the least similarity let through.

    The estimate of similarity from d differing bits of n, with k samples, is
    1 + n / 4k * ln(1 - 2d / n).
    """
    least = percent / 100 - kind.slack
    return int(kind.bits / 2 * (1 - np.exp((least - 1) * 4 * kind.samples / kind.bits))) + 1


def fine_marks(texts: DataFrame, words: int) -> DataFrame:
    """(node, mark) of ``texts`` (node, text): the fine sketch of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in chunks(batch.column(1), 500_000):
                sets = shingle_sets(part, words)
                # A sketch takes about a hundred times its size while it is made.
                for start in range(0, len(sets), FINE_SETS):
                    some = sets[start : start + FINE_SETS]
                    marks = _lists(odd_sketches(samples(some, FINE.samples), FINE.bits))
                    nodes = batch.column(0).slice(done, len(some))
                    done += len(some)
                    yield pa.RecordBatch.from_arrays([nodes, marks], ["node", "mark"])

    return texts.select("node", "text").mapInArrow(run, "node bigint, mark array<bigint>")


def shingle_counts(texts: DataFrame, words: int) -> np.ndarray:
    """In how many of ``texts`` (text) shingles are, by ``COUNTERS`` of their hashes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in chunks(batch.column(0)):
                for hashes in shingle_sets(part, words):
                    np.add.at(met, (hashes % np.uint64(COUNTERS)).astype(np.int64), 1)
        used = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(met[used])], ["counter", "n"])

    counted = texts.select("text").mapInArrow(count, "counter bigint, n bigint")
    met = counted.groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[met["counter"].to_numpy()] = met["n"].to_numpy()
    return out


def rarest(hashes: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """So many of a set's rarest shingles that any set of at least ``percent`` similarity has one of them
    among its own."""
    order = np.lexsort((hashes, counts[(hashes % np.uint64(COUNTERS)).astype(np.int64)]))
    least = -(-len(hashes) * percent // 100)
    return hashes[order[: len(hashes) - least + 1]]


def rare_members(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The members (key, node, leader) of buckets of ``texts`` (node, text) by their rarest shingles."""
    counts = shingle_counts(texts, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in chunks(batch.column(1)):
                taken = [rarest(s, counts, percent) for s in shingle_sets(part, words)]
                nodes = batch.column(0).slice(done, len(part)).to_numpy()
                done += len(part)
                keys = np.concatenate(taken).view(np.int64)
                owners = np.repeat(nodes, [len(t) for t in taken])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owners)], ["key", "node"])

    return shared_buckets(texts.select("node", "text").mapInArrow(run, "key bigint, node bigint"))


def centres(texts: DataFrame, placed: DataFrame, words: int) -> DataFrame:
    """(hub, centre): the shingles that more than half of a hub's own nodes have. Any set is right."""
    own = placed.where("label = hub").select("node", "hub")
    rows = texts.join(own, "node").select("hub", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in chunks(batch.column(1), 500_000):
                sets = shingle_sets(part, words)
                hubs = batch.column(0).slice(done, len(sets)).to_numpy()
                done += len(sets)
                of = np.repeat(hubs, [len(s) for s in sets])
                found = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(found)], ["hub", "shingle"])

    met = rows.mapInArrow(run, "hub bigint, shingle bigint").groupBy("hub", "shingle")
    met = met.agg(F.count(F.lit(1)).alias("n"))
    sizes = own.groupBy("hub").agg(F.count(F.lit(1)).alias("size"))
    common = met.join(F.broadcast(sizes), "hub").where("2 * n > size")
    return stage(common.groupBy("hub").agg(F.collect_list("shingle").alias("centre")), "centres")


def differences(texts: DataFrame, placed: DataFrame, words: int, percent: int) -> DataFrame:
    """``placed`` (node, label, hub) with the shingles that are in a node's set or the centre of its hub but
    not in both (rest), the size of the set, and its weight: two sets are similar enough where
    2 * (100 + percent) times the number of shingles common to their rests is at least the sum of their weights."""
    middle = centres(texts, placed, words)
    total = middle.agg(F.sum(F.size("centre"))).first()[0] or 0
    if total <= BROADCAST_SHINGLES:
        middle = F.broadcast(middle)
    rows = texts.join(placed, "node").join(middle, "hub", "left").select("node", "label", "hub", "text", "centre")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in chunks(batch.column(3), 500_000):
                sets = shingle_sets(part, words)
                piece = batch.slice(done, len(sets))
                done += len(sets)
                rests = []
                for s, centre in zip(sets, piece.column(4)):
                    of_hub = np.array([], np.int64) if not centre.is_valid else centre.values.to_numpy()
                    rests.append(np.setxor1d(s, of_hub.view(np.uint64), assume_unique=True))
                sizes = np.array([len(s) for s in sets], np.int64)
                apart = np.array([len(r) for r in rests], np.int64)
                flat = pa.array(np.concatenate(rests).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *piece.columns[:3],
                        pa.array(sizes),
                        pa.array((100 + percent) * apart - (100 - percent) * sizes),
                        pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(apart)]).astype(np.int32), flat),
                    ],
                    ["node", "label", "hub", "size", "weight", "rest"],
                )

    kind = "node bigint, label bigint, hub bigint, size bigint, weight bigint, rest array<bigint>"
    return stage(rows.mapInArrow(run, kind), "differences")


def first_of_rests(rows: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """(key, node, label, weight, far, left) of ``rows`` of ``differences`` with the ``low`` weight of their hub:
    so many of the rarest shingles of each rest that similar sets, one of them far, have one of these in
    common. ``left``: how many of the rest come later."""
    share = 2 * (100 + percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, left, taken = [], [], []
            low, weight, size, hubs = (
                batch.column(c).to_numpy() for c in ("low", "weight", "size", "hub")
            )
            far = weight + low > 0
            # Of the common shingles: what the least weight on the other side asks for, and what the sizes do.
            asked = -(-(weight + np.where(far, low, 1 - low)) // share)
            for i, rest in enumerate(batch.column("rest")):
                hashes = rest.values.to_numpy().view(np.uint64)
                least = max(1, asked[i], len(hashes) - (100 - percent) * size[i] // percent)
                order = np.lexsort((hashes, counts[(hashes % np.uint64(COUNTERS)).astype(np.int64)]))
                some = order[: max(0, len(hashes) - least + 1)]
                found.append(mix(hashes[some] * _ODD + hubs[i : i + 1].view(np.uint64)))
                left.append(len(hashes) - 1 - np.arange(len(some)))
                taken.append(len(some))
            if not sum(taken):
                continue
            of = np.repeat(np.arange(len(taken)), taken)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(found).view(np.int64)),
                    *(batch.column(c).take(pa.array(of)) for c in ("node", "label", "weight")),
                    pa.array(far[of]),
                    pa.array(np.concatenate(left)),
                ],
                ["key", "node", "label", "weight", "far", "left"],
            )

    kind = "key bigint, node bigint, label bigint, weight bigint, far boolean, left bigint"
    return rows.mapInArrow(run, kind)


def around_hubs(
    texts: DataFrame, placed: DataFrame, words: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Links (u, v) and pairs to confirm (u, v), which join all that are similar enough of ``placed`` (node,
    label, hub) with the same hub, see ``link_members``.

    The node of the least weight is the nearest to the centre. Whose weight with that is 0 or less is linked
    to it; all others are far. For a far one and any other to be similar, their rests must have
    shingles in common, more the farther they are, and few are left where many of a group are alike.
    """
    rows = differences(texts, placed, words, percent)
    nearest = F.min(F.struct("weight", "node")).alias("nearest")
    lows = rows.groupBy("hub").agg(nearest).select("hub", "nearest.node", "nearest.weight")
    lows = stage(lows.toDF("hub", "nearest", "low"), "lows")
    rows = rows.join(F.broadcast(lows), "hub")
    links = rows.where("weight + low <= 0 and node <> nearest").selectExpr("nearest AS u", "node AS v")

    met = rows.select(F.explode("rest").alias("shingle"))
    met = met.groupBy(F.col("shingle").bitwiseAND(F.lit(COUNTERS - 1)).alias("counter"))
    met = met.agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[met["counter"].to_numpy()] = met["n"].to_numpy()
    keyed = stage(first_of_rests(rows, counts, percent), "keyed")
    u, v = (
        keyed.select(*[F.col(c).alias(f"{c}_{side}") for c in keyed.columns]) for side in ("u", "v")
    )
    later = F.least("left_u", "left_v") + 1
    meets = (
        (F.col("key_u") == F.col("key_v"))
        & (F.col("label_u") != F.col("label_v"))
        & (~F.col("far_v") | (F.col("node_u") < F.col("node_v")))
        & (later * (2 * (100 + percent)) >= F.col("weight_u") + F.col("weight_v"))
    )
    pairs = u.where("far_u").join(v, meets)
    pairs = pairs.select(F.least("node_u", "node_v").alias("u"), F.greatest("node_u", "node_v").alias("v"))
    return links, pairs.distinct()


def set_digest(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(
        pa.list_(pa.int64())
    )


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, digest of the set, band keys, odd sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in chunks(batch.column(1)):
                sets = shingle_sets(part, words)
                filled = np.flatnonzero([len(s) for s in sets])
                bands = sketches = pa.nulls(len(sets), pa.list_(pa.int64()))
                if len(filled):
                    sampled = samples([sets[i] for i in filled])
                    row_of = np.full(len(sets), -1)
                    row_of[filled] = np.arange(len(filled))
                    take = pa.array(row_of, mask=row_of < 0)
                    bands = _lists(band_keys(sampled)).take(take)
                    sketches = _lists(odd_sketches(sampled)).take(take)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_digest(s) for s in sets], pa.binary()),
                        bands,
                        sketches,
                    ],
                    ["doc_id", "n_shingles", "digest", "bands", "sketch"],
                )
                done += len(sets)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_shingles bigint, digest binary, bands array<bigint>, sketch array<bigint>",
    )


def set_texts(docs: DataFrame, words: int) -> DataFrame:
    """(digest, text): one text of each distinct non-empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch.column(0)):
                digests = pa.array([set_digest(s) for s in shingle_sets(part, words)], pa.binary())
                yield pa.RecordBatch.from_arrays([digests, part], ["digest", "text"])

    made = docs.select("text").mapInArrow(run, "digest binary, text string")
    return made.where("digest is not null").dropDuplicates(["digest"])


def confirm(pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (u, v, text_u, text_v) whose full sets are similar enough, as (u, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for column in (batch.column(2), batch.column(3)):
                coded = column.dictionary_encode()
                sets = shingle_sets(coded.dictionary, words)
                sides.append([sets[i] for i in coded.indices.to_numpy()])
            similar = []
            for a, b in zip(*sides):
                common = len(np.intersect1d(a, b, assume_unique=True))
                similar.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], ["u", "v"]
            ).filter(pa.array(similar, pa.bool_()))

    return pairs.select("u", "v", "text_u", "text_v").mapInArrow(run, "u bigint, v bigint")


def _differing(a: Column, b: Column) -> Column:
    counted = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(counted, F.lit(0), lambda total, n: total + n)


def find_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id of its group)
    and kept (whether it is that document)."""
    small_batches(docs.sparkSession)
    sketched = stage(sketch(docs, words), "sketches")
    distinct = sketched.where("digest is not null").dropDuplicates(["digest"])
    nodes = stage(
        distinct.select(F.monotonically_increasing_id().alias("node"), "digest", "bands", "sketch"),
        "nodes",
    )
    members = shared_buckets(nodes.select(F.explode("bands").alias("key"), "node"))
    needed = members.select("node").distinct().join(nodes.select("node", "digest"), "node")
    texts = stage(set_texts(docs, words).join(needed, "digest").select("node", "text"), "texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        for side in ("u", "v"):
            named = texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
            pairs = pairs.join(named, side)
        return confirm(pairs, words, percent)

    def close(kind: Sketch) -> Callable[[Column, Column], Column]:
        most = most_differing(percent, kind)
        return lambda a, b: _differing(a, b) <= most

    def refined(apart: DataFrame) -> DataFrame:
        return fine_marks(texts.join(apart, "node"), words)

    def finer(large: DataFrame) -> DataFrame:
        return rare_members(texts.join(large, "node"), words, percent)

    def around(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
        return around_hubs(texts, placed, words, percent)

    coarse = nodes.select("node", F.col("sketch").alias("mark"))
    final = link_members(
        members, coarse, close(COARSE), confirmed, refined, close(FINE), finer, around=around
    )
    by_digest = nodes.join(final, "node").select("digest", "label")
    rows = sketched.select("doc_id", "n_shingles", "digest").join(by_digest, "digest", "left")
    lone = F.when(F.col("label").isNull(), F.col("digest"))
    group = F.struct(F.col("label").alias("label"), lone.alias("digest"))
    rows = rows.withColumn("group", group)
    smallest = stage(
        rows.where("digest is not null").groupBy("group").agg(F.min("doc_id").alias("component_id")),
        "smallest",
    )
    named = rows.join(smallest, "group", "left")
    own = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select(
        "doc_id",
        "n_shingles",
        own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"),
    )


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group. Rows that share a doc_id go together."""
    kept = find_groups(docs, words, percent).where("kept").select("doc_id").distinct()
    name = free_name(docs, "kept_id")
    kept = kept.withColumnRenamed("doc_id", name)
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")
