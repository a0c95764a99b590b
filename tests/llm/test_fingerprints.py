"""Fingerprints against a plain version with another implementation of the hash, and exact likeness."""

import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from mercatura.llm import fingerprints
from mercatura.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
SPLIT = re.compile(r"[\x20\x09-\x0D]+")
MASK = (1 << 64) - 1


def hashed(values):
    """The hash of a row of strings and longs: each one's hash is the seed of the next."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<Q", v & MASK)
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed


def hashed_with_bin(sample, number):
    """As ``hashed`` of a long and an int, which takes four bytes."""
    seed = xxhash.xxh64_intdigest(struct.pack("<Q", sample), seed=42)
    return xxhash.xxh64_intdigest(struct.pack("<I", number), seed=seed)


def shingles(text, words=5):
    parts = [w for w in SPLIT.split((text or "").lower()) if w]
    if not parts:
        return set()
    return {tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))}


def fingerprint(text, words=5):
    width = 63 - 8
    least = {}
    for s in shingles(text, words):
        h = hashed([hashed([w]) for w in s]) & (1 << 63) - 1
        least[h >> width] = min(h & (1 << width) - 1, least.get(h >> width, 1 << 63))
    samples = []
    for b in range(fingerprints.BINS):
        drawn = hashlib.md5(f"bin {b}".encode()).digest()
        place, step = b, 0
        while least and place not in least:
            place = (drawn[0] + step * (drawn[1] | 1)) % fingerprints.BINS
            step += 1
        samples.append(hashed_with_bin(least[place], b) & 15 if least else 0)
    return "".join(f"{s:x}" for s in samples)


def likeness(a, b):
    agree = sum(x == y for x, y in zip(a, b)) / len(a)
    return max(0.0, (agree - 1 / 16) / (15 / 16))


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    out = [None, "", " \t\n", "one", "ONE", "one two three four", "one two three four five", "É é ß tail " * 4]
    out += [" ".join(rng.choices(words, k=rng.randrange(1, 300))) for _ in range(40)]
    return out + ["very " + "long " * 30_000, "x" * 200_000]


def neighbours(docs):
    """[(doc_id, n_chars, edited, next text)] of rows (doc_id, text)."""
    def mark(row):
        return xxhash.xxh64_intdigest(
            row[1].encode(), seed=xxhash.xxh64_intdigest(struct.pack("<I", row[0] is None), seed=42)
        )

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    rows = [(i, t or "") for i, t in docs]
    order = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0), signed(mark(r))))
    after = {row: order[(at + 1) % len(order)] for at, row in enumerate(order)}
    out = []
    for row in rows:
        third = len(row[1]) // 3
        following = after[row][1]
        out.append((row[0], len(row[1]), row[1][: len(row[1]) - third] + following[:third], row[1], following))
    return out


def expected(docs):
    out = []
    for doc_id, n, edited, text, following in neighbours(docs):
        a, b, c = fingerprint(text), fingerprint(edited), fingerprint(following)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((str(doc_id), n, sha, a, b, round(likeness(a, b), 9), round(likeness(a, c), 9)))
    return sorted(out)


def found(df):
    return sorted(
        (str(r[0]), *r[1:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect()
    )


def test_fingerprints_equal_the_plain_version(spark):
    table = spark.createDataFrame([(t, "x") for t in texts()], "text string, mark_words string")
    made = fingerprints.with_fingerprint(table, "text", "mark")
    for row in made.select("text", fingerprints.as_hex(F.col("mark")).alias("hex")).collect():
        assert row.hex == fingerprint(row.text)
    assert made.columns == ["text", "mark_words", "mark"]


def test_neighbours_null_ids_copies_and_extra_columns(spark):
    docs = [(i, t) for i, t in enumerate(texts()[:20])]
    docs += [(None, "no id here"), (None, "another without id"), (3, "x y z of an id given twice")]
    docs += [(50, "a row given four times, with words enough")] * 4 + [(-2, "below " * 9), (51, "")]
    rows = [(i, t, "x", 0) for i, t in docs]
    table = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, copies int")
    for parts in (1, 5):
        made = fingerprints.compare_neighbours(table.repartition(parts))
        assert found(fingerprints.digests(made)) == expected(docs)


@pytest.mark.parametrize("docs", [[], [(1, "a single document of some words and no other")], [(None, None)]])
def test_none_and_single_documents(spark, docs):
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(fingerprints.digests(fingerprints.compare_neighbours(table))) == expected(docs)


def test_estimates_are_near_the_exact_likeness(spark):
    """Copies of a text with ever more of its words replaced; the error is that of 256 samples."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(5_000)]
    pairs = []
    for size in (20, 60, 200, 1000):
        for share in (0.0, 0.05, 0.1, 0.2, 0.5, 0.9):
            for _ in range(12):
                a = rng.choices(words, k=size)
                cut = int(size * share)
                pairs.append((" ".join(a), " ".join(a[: size - cut] + rng.choices(words, k=cut))))
    table = spark.createDataFrame(pairs, "a string, b string")
    table = fingerprints.with_fingerprint(table, "a", "fa")
    table = fingerprints.with_fingerprint(table, "b", "fb")
    rows = table.select("a", "b", fingerprints.likeness(F.col("fa"), F.col("fb")).alias("near")).collect()
    errors = [r.near - jaccard(r.a, r.b) for r in rows]
    assert abs(sum(errors) / len(errors)) < 0.01
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.045
    assert all(r.near == 1 for r in rows if r.a == r.b)


def test_query_equals_the_plain_version(spark, tmp_path):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = found(QUERIES["op13_fingerprints"](spark, SMALL))
    assert got == expected(docs)


def test_no_python_on_the_path(spark):
    table = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    plan = fingerprints.compare_neighbours(table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
