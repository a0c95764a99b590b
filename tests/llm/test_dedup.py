"""Exact, near and substring duplicates: small tables against plain Python."""

import hashlib
import re
from itertools import combinations

import pyarrow as pa
import pytest

from mercatura.llm import exact_dedup, near_dedup, substring_dedup, word_hash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, digest string, keep_id int, node int"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def table(spark, rows):
    return spark.createDataFrame([(d, t, "d", 1, 2) for d, t in rows], SCHEMA)


# exact ------------------------------------------------------------------------------------


EXACT = [(1, "Same"), (2, "same"), (3, "SAME"), (4, None), (5, ""), (6, "É"), (7, "é"), (None, "alone")]
EXACT += [(100 + i, f"copy {i % 3}") for i in range(90)] + [(8, "again"), (8, "again"), (None, "copy 1")]


@pytest.mark.parametrize("slots", [2, 1024])
def test_exact_groups(spark, slots):
    groups = {}
    for doc_id, text in EXACT:
        groups.setdefault(lowered(text), []).append(doc_id)
    expected = []
    for doc_id, text in EXACT:
        same = groups[lowered(text)]
        keep = max((d for d in same if d is not None), default=None)
        digest = hashlib.sha256(lowered(text).encode()).digest()
        expected.append((doc_id, keep, len(same), doc_id == keep, digest))
    got = exact_dedup.find_groups(table(spark, EXACT).repartition(5), slots).collect()
    found = [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in got]
    assert sorted(map(str, found)) == sorted(map(str, expected))


@pytest.mark.parametrize("slots", [2, 1024])
def test_exact_keep_one(spark, slots):
    kept = exact_dedup.keep_one(table(spark, EXACT).repartition(5), slots)
    assert kept.columns == ["doc_id", "text", "digest", "keep_id", "node"]
    found = [(r.doc_id, lowered(r.text)) for r in kept.collect()]
    groups = {}
    for doc_id, text in EXACT:
        groups.setdefault(lowered(text), []).append(doc_id)
    best = {t: max((d for d in ids if d is not None), default=None) for t, ids in groups.items()}
    assert sorted(map(str, found)) == sorted(str((d, t)) for t, d in best.items())


def test_exact_empty_table(spark):
    nothing = table(spark, EXACT).limit(0)
    assert exact_dedup.find_groups(nothing).count() == 0
    assert exact_dedup.keep_one(nothing).count() == 0


def test_misra_gries_keeps_what_is_frequent():
    counts = {b"%d" % i: n for i, n in enumerate([50, 30, 5, 5, 5, 5])}
    kept = exact_dedup.prune(dict(counts), 2)
    assert set(kept) == {b"0", b"1"} and len(exact_dedup.prune({b"a": 1}, 2)) == 1


# near -------------------------------------------------------------------------------------


def shingles(text, words):
    found = SPACED.findall(lowered(text))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def near_brute_force(rows, words):
    sets = [shingles(t, words) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            group[root(a)] = root(b)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        names.setdefault(root(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        name = min((d for d in names[root(i)] if d is not None), default=None)
        name = name if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), name, doc_id == name))
    return sorted(map(str, out))


def near_rows():
    base = [f"w{i}" for i in range(120)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (5, "two"), (None, "lonely words here")]
    for i in range(40):  # a group of near copies, some of them only near to one another
        words = list(base)
        for j in range(i % 9):
            words[(i * 13 + j * 29) % 120] = f"x{i}-{j}"
        rows.append((10 + i, " ".join(words)))
    rows += [(60 + i, " ".join(f"v{(i * 7 + j) % 97}" for j in range(60))) for i in range(30)]
    rows += [(200, "a b c d e f"), (200, "a b c d e f"), (200, "other text of the same id")]
    rows += [(300, "long " * 3000 + " ".join(base)), (301, "Long " * 2500 + " ".join(base))]
    return rows


@pytest.mark.parametrize("words", [2, 5])
def test_near_groups_equal_all_pairs(spark, words):
    rows = near_rows()
    got = near_dedup.find_groups(table(spark, rows).repartition(3), words).collect()
    assert sorted(str(tuple(r)) for r in got) == near_brute_force(rows, words)


def test_near_keep_one_and_empty_table(spark):
    rows = near_rows()
    kept = near_dedup.keep_one(table(spark, rows))
    names = [r.split(",") for r in near_brute_force(rows, near_dedup.WORDS)]
    expected = {n[0].strip("(") for n in names if "True" in n[-1]}
    assert {str(r.doc_id) for r in kept.collect()} == expected
    assert kept.columns == ["doc_id", "text", "digest", "keep_id", "node"]
    assert near_dedup.find_groups(table(spark, rows).limit(0)).count() == 0


def test_sketches_pass_what_is_similar():
    import numpy as np

    rng = np.random.default_rng(5)
    for kind in (near_dedup.COARSE, near_dedup.FINE):
        most = near_dedup.most_differing(80, kind)
        for size in (10, 80, 400):
            for _ in range(20):
                both = rng.integers(0, 2**63, size, dtype=np.uint64)
                rest = size // 10
                sets = [np.sort(both[rest:]), np.sort(both[: size - rest])]
                a, b = near_dedup.odd_sketches(near_dedup.samples(sets, kind.samples), kind.bits)
                differing = sum((int(x) & (1 << 64) - 1).bit_count() for x in (a ^ b).tolist())
                assert differing <= most


# passages ---------------------------------------------------------------------------------


def passages_brute_force(rows, length=13):
    words = [SPACED.findall(t or "") for _, t in rows]
    first = {}
    for (doc_id, _), found in zip(rows, words):
        for i in range(len(found) - length + 1):
            if doc_id is not None:
                key = tuple(found[i : i + length])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for (doc_id, _), found in zip(rows, words):
        gone = set()
        for i in range(len(found) - length + 1):
            if doc_id is not None and first[tuple(found[i : i + length])] < doc_id:
                gone.update(range(i, i + length))
        out.append((doc_id, len(found), len(gone), " ".join(w for i, w in enumerate(found) if i not in gone)))
    return sorted(map(str, out))


def test_passages_equal_all_windows(spark):
    shared = " ".join(f"p{i}" for i in range(30))
    exact = " ".join(f"q{i}" for i in range(13))
    rows = [(0, None), (1, ""), (2, "short"), (None, shared), (None, shared)]
    rows += [(10 + i, f"a{i} b{i}\n{shared} c{i} {exact if i % 2 else ''}") for i in range(30)]
    rows += [(3, exact), (4, exact.upper()), (5, " ".join(exact.split()[:12])), (6, shared[: len(shared) // 2])]
    rows += [(70, "same " * 4000), (71, "same " * 20), (72, "same " * 5000 + shared), (72, shared), (72, "x")]
    got = substring_dedup.remove_repeats(table(spark, rows).repartition(4)).collect()
    assert sorted(str(tuple(r)) for r in got) == passages_brute_force(rows)
    spans = substring_dedup.find_repeats(table(spark, rows)).collect()
    removed = {r.doc_id: sum(s.end_word - s.start_word for s in r.repeats) for r in spans}
    assert all(s.end_word - s.start_word >= 13 for r in spans for s in r.repeats)
    assert removed[11] == 30 + 13 and removed[0] == 0
    assert substring_dedup.remove_repeats(table(spark, rows).limit(0)).count() == 0


# words ------------------------------------------------------------------------------------


@pytest.mark.parametrize("lower", [True, False])
def test_word_hashes(monkeypatch, lower):
    texts = ["  a b  c\x0b d\n", "", None, "A", "x\x1cy z", "é  b\x85c \xa0 d", "ab", "abc ab", "k" * 300]
    words = [SPACED.findall((lowered(t) if lower else t) or "") for t in texts]
    for size in (2_000_000, 7):
        monkeypatch.setattr(word_hash, "CHUNK_BYTES", size)
        hashes, bounds = word_hash.word_hashes(pa.array(["skip", *texts]).slice(1), lower)
        assert bounds.tolist() == [sum(map(len, words[:i])) for i in range(len(texts) + 1)]
        flat = [w for found in words for w in found]
        assert len(set(flat)) == len(set(hashes.tolist())) == len(set(zip(flat, hashes.tolist())))
