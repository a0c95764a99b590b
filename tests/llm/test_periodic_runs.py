"""Periodic runs against the definition, word by word."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mercatura.llm import periodic_runs
from mercatura.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(words, least=6, exponent=4):
    """All runs by the definition: maximal stretches of every period, smallest period first."""
    n, found = len(words), {}
    for period in range(1, n // exponent + 1):
        start = 0
        while start + period < n:
            end = start
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end - start + period
            if length >= max(least, exponent * period):
                found.setdefault((start, length), period)
            start = end + 1
    return sorted((s, length, p) for (s, length), p in found.items())


def collapsed(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs(sequences):
    codes = np.array([c for s in sequences for c in s], np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sequences])]).astype(np.int64)
    out = [[] for _ in sequences]
    for start, length, period in periodic_runs.find_runs(codes, bounds).tolist():
        at = int(np.searchsorted(bounds, start, "right")) - 1
        out[at].append((start - int(bounds[at]), length, period))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4))
def test_small_alphabets(sequences):
    assert runs(sequences) == [brute_force(s) for s in sequences]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
def test_planted_repeats(parts):
    sequence = [c for part, times in parts for c in part * times]
    assert runs([sequence, sequence[::-1], sequence]) == [
        brute_force(sequence), brute_force(sequence[::-1]), brute_force(sequence)
    ]


def test_long_periods_and_partial_last_period():
    rng = random.Random(1)
    for period in (1, 2, 3, 4, 5, 7, 8, 9, 31, 32, 33, 100):
        word = [rng.randrange(10**6) for _ in range(period)]
        for length in (4 * period - 1, 4 * period, 4 * period + 1, 9 * period + period // 2):
            sequence = [-1, *[word[i % period] for i in range(length)], -2]
            sequence = [c + 2 for c in sequence]
            assert runs([sequence]) == [brute_force(sequence)]


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(3, np.int64), np.array([0, 3]), exponent=3)


def texts():
    rng = random.Random(2)
    out = [(1, None), (2, ""), (3, " \n\t "), (4, "a " * 5), (5, "a\ta\na a  a a"), (6, "A a A a A a A a")]
    out += [(7, "x\x0by\x0cz\r" * 7), (8, "  b" * 6), (None, "n m " * 6), (None, None), (4, "a " * 5)]
    out += [(9, " ".join(f"w{i}" for i in range(3000))), (10, "ab " * 40_000), (11, "y" * 3_000_000 + " z" * 7)]
    for i in range(20, 90):
        words = [rng.choice("abcd") for _ in range(rng.randrange(1, 80))]
        out.append((i, " ".join(words)))
    return out


def expected(doc_id, words):
    found = brute_force(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, sha(listed), sha(collapsed(words, found)))


def test_texts(spark):
    rows = [(i, t, "x", 1) for i, t in texts()]
    table = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int").repartition(3)
    got = [
        (str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed)
        for r in periodic_runs.runs_of(table).collect()
    ]
    wanted = []
    for doc_id, text in texts():
        words = SPACED.findall(text or "")
        found = brute_force(words) if len(words) < 10_000 else [(0, len(words), 1)]
        wanted.append((str(doc_id), len(words), found, collapsed(words, found)))
    assert sorted(got) == sorted(wanted)
    assert periodic_runs.runs_of(table.limit(0)).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    docs = [(i, " ".join((t or "").split(" ")[:400])) for i, t in docs]  # quadratic in a text's words
    docs += [(1000 + i, t) for i, t in texts() if i is not None and (t is None or len(t) < 30_000)]
    docs += [(None, "a b " * 9)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, map(tuple, QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect())))
    wanted = [expected(i, planted(i, SPACED.findall(t or ""))) for i, t in docs]
    assert got == sorted(map(str, wanted))
    assert sum(r[1] > 0 for r in wanted) > 10
