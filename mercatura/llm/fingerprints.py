"""Document fingerprints by one-permutation MinHash, with built-in functions only.

A text's shingles are hashed once. The leading bits of a hash name one of ``BINS`` bins, and the
least hash of a bin is its sample. An empty bin takes the sample of another one, found by probing the bins in
an order of its own (a pseudo-random start and odd step), so two texts fill it from the same place
wherever they can. Only the ``BITS`` low bits of each sample, hashed once more with its bin so that a
sample taken twice does not count as the same chance twice, are kept, packed into words of 64 bits.
Two fingerprints are compared by XOR and a bit count; the share of samples that agrees by chance,
2^-BITS, is taken off.

Everything about a text happens in its own row. To find the least hash per bin, one mark per bin, the
largest number of that bin, is sorted among the hashes: what follows a mark is the next bin's least.

Defined results: texts are compared by words in lower case that end at ASCII white space. A shingle has
``words`` words; a text with fewer has one shingle, all of it. Null, empty and blank texts have no shingle;
their fingerprint is all zeros, and the likeness of two of them is 1, as of any equal fingerprints. In
``compare_neighbours``, documents are ordered by descending id, no id last, then by a hash of the text; a row
given twice (same id and text) has one place, and each copy gets its result. After the last comes
the first, and a single document follows itself. No rows give no rows. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.llm.common import free_name, stage

BINS = 256
BITS = 4
WORDS = 5
SEPARATOR = r"[\x20\x09-\x0D]+"
_PER_WORD = 64 // BITS
_WORDS_KEPT = BINS // _PER_WORD
_BIN_SHIFT = 63 - (BINS.bit_length() - 1)
_EMPTY = (1 << _BIN_SHIFT) - 1
_LOWEST = sum(1 << at for at in range(0, 64, BITS))
"""The lowest bit of each kept sample in a word."""
_ROW_BITS = 33
"""monotonically_increasing_id has the row's number in its lower 33 bits."""
_COPIES = 1_000


def _probes() -> str:
    """SQL array with the start and the odd step of each bin's probes; an odd step visits every bin."""
    drawn = [hashlib.md5(f"bin {b}".encode()).digest() for b in range(BINS)]
    return f"array({', '.join(f'struct({d[0] % BINS} AS a, {d[1] % BINS | 1} AS b)' for d in drawn)})"


def with_fingerprint(df: DataFrame, text: str, name: str, words: int = WORDS) -> DataFrame:
    """``df`` with the fingerprint of its column ``text``, an array of longs, as ``name``."""
    split, hashes, samples, filled = (
        free_name(df, f"{name}_{part}") for part in ("words", "hashes", "samples", "filled")
    )
    spaced = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SEPARATOR)
    hashed = F.transform(F.array_remove(spaced, ""), lambda w: F.xxhash64(w))
    later = "".join(f", get({split}, i + {k})" for k in range(1, words))
    count = f"if(size({split}) = 0, 0, greatest(1, size({split}) - {words - 1}))"
    marks = ", ".join(f"{b << _BIN_SHIFT | _EMPTY}L" for b in range(BINS))
    shingles = f"transform(slice({split}, 1, {count}), (w, i) -> xxhash64(w{later}) & {2**63 - 1}L)"
    firsts = f"filter({hashes}, (h, i) -> i = 0 OR get({hashes}, i - 1) & {_EMPTY}L = {_EMPTY}L)"
    tried = ", ".join(f"get({samples}, (p.a + {t} * p.b) & {BINS - 1})" for t in range(BINS))
    packed = ", ".join(
        f"aggregate(slice({filled}, {word * _PER_WORD + 1}, {_PER_WORD}), 0L, "
        f"(all, v) -> shiftleft(all, {BITS}) | v)"
        for word in range(_WORDS_KEPT)
    )
    return (
        df.withColumn(split, hashed)
        .withColumn(hashes, F.expr(f"sort_array(concat({shingles}, array({marks})))"))
        .withColumn(samples, F.expr(f"transform({firsts}, h -> nullif(h & {_EMPTY}L, {_EMPTY}L))"))
        .withColumn(
            filled, F.expr(f"transform({_probes()}, (p, i) -> coalesce(get({samples}, i), {tried}))")
        )
        .withColumn(
            filled,
            F.expr(f"transform({filled}, (v, i) -> if(v IS NULL, 0L, xxhash64(v, i) & {(1 << BITS) - 1}L))"),
        )
        .withColumn(name, F.expr(f"array({packed})"))
        .drop(split, hashes, samples, filled)
    )


def as_hex(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda w: F.lower(F.lpad(F.hex(w), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles (Jaccard) of two fingerprints, 0 to 1."""
    apart = F.lit(0)
    for word in range(_WORDS_KEPT):
        bits = F.get(a, F.lit(word)).bitwiseXOR(F.get(b, F.lit(word)))
        folded = bits
        for shift in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(bits, shift))
        apart = apart + F.bit_count(folded.bitwiseAND(F.lit(_LOWEST)))
    chance = 1 / (1 << BITS)
    return F.greatest(F.lit(0.0), ((BINS - apart) / F.lit(float(BINS)) - chance) / (1 - chance))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null is empty), and two columns without nulls that tell rows apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        text.alias("text"),
        F.coalesce("doc_id", F.lit(0)).alias("number"),
        F.xxhash64(F.col("doc_id").isNull(), text).alias("mark"),
    )


KEY = ["number", "mark"]


def _in_order(prints: DataFrame) -> DataFrame:
    """The rows of ``prints`` with the key, length and fingerprint of the document that follows each.

    The rows are sorted by range and staged with their place. The row after the last one of a partition is
    the first of the next partition that has any: one row per partition is all that meets.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("mark")]
    placed = stage(prints.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", _ROW_BITS)
    ends = placed.groupBy(part.alias("part")).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    by_part, whole = Window.orderBy("part"), Window.partitionBy()
    after = F.coalesce(F.lead("first").over(by_part), F.min("first").over(whole))
    # At most spark.sql.shuffle.partitions rows: fits one task and a broadcast.
    ends = F.broadcast(ends.select("part", "last", after.alias("after")))
    led = placed.join(ends, part == F.col("part"))
    led = led.withColumn("next_at", F.when(F.col("at") == F.col("last"), F.col("after")).otherwise(F.col("at") + 1))
    following = placed.select(
        F.col("at").alias("next_at"), *[F.col(c).alias(f"next_{c}") for c in (*KEY, "fingerprint")]
    )
    return stage(led.join(following, "next_at").drop("part", "last", "after", "at", "next_at"), "pairs")


def compare_neighbours(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited (the text with its last third replaced by
    as many characters of the document that follows), fingerprint, edited_fingerprint, near_edited and near_next,
    the likeness of its fingerprint to that of the edited text and of the document that follows."""
    rows = _keyed(docs)
    own = with_fingerprint(rows, "text", "fingerprint", words)
    cells = [F.col("fingerprint")[i].alias(f"cell_{i}") for i in range(_WORDS_KEPT)]
    own = own.select(*KEY, "doc_id", F.length("text").alias("n_chars"), *cells)
    named = ["doc_id", "n_chars", *[f"cell_{i}" for i in range(_WORDS_KEPT)]]
    prints = own.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in named])
    fingerprint = F.array(*[F.col(f"cell_{i}") for i in range(_WORDS_KEPT)]).alias("fingerprint")
    prints = stage(prints.select(*KEY, "doc_id", "n_chars", "copies", fingerprint), "prints")
    pairs = _in_order(prints)

    texts = rows.select(*KEY, "text").groupBy(*KEY).agg(F.first("text").alias("text"))
    replaced = F.floor(F.col("n_chars") / 3).cast("int")
    wanted = pairs.select(
        *[F.col(c).alias(f"of_{c}") for c in KEY],
        *[F.col(f"next_{c}").alias(c) for c in KEY],
        replaced.alias("wanted"),
    )
    heads = texts.join(wanted, KEY).select(
        *[F.col(f"of_{c}").alias(c) for c in KEY], F.substring("text", F.lit(1), F.col("wanted")).alias("head")
    )
    joined = texts.join(pairs, KEY).join(heads, KEY)
    kept = F.substring("text", F.lit(1), F.col("n_chars") - replaced)
    edited = joined.select(
        "doc_id", "n_chars", "copies", "fingerprint", "next_fingerprint", F.concat(kept, "head").alias("edited")
    )
    compared = with_fingerprint(edited, "edited", "edited_fingerprint", words).select(
        "doc_id",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        "copies",
    )
    # Copies come back in two steps, so that no array grows with their number alone.
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / _COPIES)))
    compared = compared.withColumn("block", blocks)
    left = F.least(F.col("copies") - F.col("block") * _COPIES, F.lit(_COPIES)).cast("int")
    compared = compared.withColumn("copy", F.explode(F.array_repeat(F.lit(True), left)))
    return compared.drop("copies", "block", "copy")


def digests(compared: DataFrame) -> DataFrame:
    """The rows of ``compare_neighbours`` with a digest for the edited text and fingerprints as hex."""
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_hex(F.col("fingerprint")).alias("fingerprint"),
        as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
