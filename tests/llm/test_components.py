"""Linking members of buckets: large ones of unlike nodes are dealt anew and lose no link."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercatura.llm import components, near_dedup


def groups(rows):
    found = defaultdict(set)
    for node, label in rows:
        found[label].add(node)
    return sorted(sorted(g) for g in found.values() if len(g) > 1)


def linked(spark, nodes, buckets, same, finer):
    """Groups of nodes by ``link_members``, and how many pairs were compared."""
    compared = []

    def confirm(pairs):
        compared.append(pairs.count())
        return pairs.where(same).select("u", "v")

    keys = spark.range(nodes).select(buckets.alias("key"), F.col("id").alias("node"))
    marks = spark.range(nodes).select(F.col("id").alias("node"), F.lit(0).alias("mark"))
    members = components.shared_buckets(keys)
    found = components.link_members(members, marks, lambda a, b: F.lit(True), confirm, finer=finer)
    return groups(found.select("node", "label").collect()), sum(compared)


def pairs_of_nodes(large):
    return components.shared_buckets(large.select((F.col("node") / 2).cast("bigint").alias("key"), "node"))


def test_unlike_nodes_in_one_bucket_take_linear_work(spark):
    nodes = 20_000
    same = F.floor(F.col("u") / 2) == F.floor(F.col("v") / 2)
    found, compared = linked(spark, nodes, F.lit(1).cast("bigint"), same, pairs_of_nodes)
    assert found == [[i, i + 1] for i in range(0, nodes, 2)]
    assert compared < 2 * nodes


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_finer_buckets_link_what_all_pairs_do(spark, buckets):
    nodes = 300
    key = F.floor(F.col("id") / 2 % buckets).cast("bigint")
    same = F.floor(F.col("u") / 2) == F.floor(F.col("v") / 2)
    finer, few = linked(spark, nodes, key, same, pairs_of_nodes)
    plain, many = linked(spark, nodes, key, same, None)
    assert finer == plain == [[i, i + 1] for i in range(0, nodes, 2)]
    assert few <= many


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_similar_sets_share_a_rare_shingle(percent):
    rng = np.random.default_rng(1)
    for _ in range(300):
        size = int(rng.integers(1, 60))
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        b = a.copy()
        gone = rng.permutation(size)[: int(rng.integers(0, size + 1))]
        b[gone] = rng.integers(0, 2**63, len(gone), dtype=np.uint64)
        a, b = np.unique(a), np.unique(np.concatenate([b, a[: int(rng.integers(0, 2))]]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= percent * (len(a) + len(b) - common):
            counts = rng.integers(0, 4, near_dedup.COUNTERS)
            taken = [near_dedup.rarest(s, counts, percent) for s in (a, b)]
            assert len(np.intersect1d(*taken))


def template_rows(seed=3, passage=70, own=30, documents=240):
    """Documents with a passage in common, a few also with most of their own words."""
    rng = random.Random(seed)
    shared = [f"p{i}" for i in range(passage)]
    rows = []
    for i in range(documents):
        rest = [f"d{i // 3}x{k}" for k in range(own)] if i % 9 < 3 else [f"n{i}x{k}" for k in range(own)]
        for _ in range(rng.randrange(4)):
            rest[rng.randrange(own)] = f"e{rng.random()}"
        rows.append((i, " ".join(shared + rest)))
    return rows


@pytest.mark.parametrize("words", [2, 5])
def test_a_shared_passage_equals_all_pairs(spark, words, monkeypatch):
    monkeypatch.setattr(components, "LARGE", 8)
    rows = template_rows()
    dealt = []
    plain = near_dedup.rare_members

    def rare_members(texts, words, percent):
        members = plain(texts, words, percent)
        dealt.append(texts.count())
        # The passage is no key, so buckets hold a few documents only.
        assert members.groupBy("key").count().agg(F.max("count")).first()[0] <= 3
        return members

    monkeypatch.setattr(near_dedup, "rare_members", rare_members)
    sets = []
    for _, text in rows:
        w = text.split()
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)})
    root = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
            low, high = sorted((root[i], root[j]))
            root = [low if r == high else r for r in root]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_dedup.find_groups(docs, words).collect()}
    assert found == dict(enumerate(root))
    assert dealt and dealt[0] > 100
    assert len(set(root)) < len(rows) - 20


def test_many_texts_and_none_in_the_counts(spark):
    texts = spark.createDataFrame([("a b c",), ("a b d",), (None,), ("",)], "text string")
    assert int(near_dedup.shingle_counts(texts, 2).sum()) == 4
    assert int(near_dedup.shingle_counts(texts.limit(0), 2).sum()) == 0


def alike_texts(documents, seed=5, size=90, most=20):
    """Variants of one text, with few to many words changed: about the wanted similarity from each other."""
    rng = random.Random(seed)
    shared = [f"p{i}" for i in range(size)]
    texts = []
    for i in range(documents):
        text = list(shared)
        for at in rng.sample(range(size), int(most * rng.random() ** 1.5)):
            text[at] = f"e{rng.randrange(10**9)}"
        texts.append(" ".join(text))
    return texts


def similar_sets(texts, words):
    """Pairs of places of texts that are linked by definition."""
    split = [t.split() for t in texts]
    sets = [{tuple(w[i : i + words]) for i in range(len(w) - words + 1)} for w in split]
    for i, j in combinations(range(len(texts)), 2):
        common = len(sets[i] & sets[j])
        if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
            yield i, j


def joined(links):
    """The smallest node that each node of ``links`` is joined with."""
    root = {}
    for u, v in links:
        low, high = sorted((root.setdefault(u, u), root.setdefault(v, v)))
        if low != high:
            root = {n: low if r == high else r for n, r in root.items()}
    return root


def test_many_sets_about_as_similar_as_wanted_take_few_pairs(spark, monkeypatch):
    words = 2
    monkeypatch.setattr(components, "LARGE", 8)
    compared = []
    plain = near_dedup.confirm

    def confirm(pairs, words, percent):
        compared.append(pairs.select("u", "v").count())
        return plain(pairs, words, percent)

    monkeypatch.setattr(near_dedup, "confirm", confirm)
    texts = alike_texts(500, most=14)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_dedup.find_groups(docs, words).collect()}
    root = joined(similar_sets(texts, words))
    assert found == {i: root.get(i, i) for i in range(len(texts))}
    # All after the first, where each set meets the leaders of its buckets.
    assert sum(compared[1:]) < len(texts)


@pytest.mark.parametrize("seed", range(3))
def test_around_hubs_joins_what_all_pairs_do(spark, seed):
    rng = random.Random(seed)
    texts = alike_texts(60, seed) + alike_texts(30, seed, 40, 10) + [f"x{i} y z w v" for i in range(20)]
    hubs = [components.NO_HUB, 3, 70, 95]
    placed = {(n, rng.choice(hubs)) for n in range(len(texts)) for _ in range(2)} | {(n, 3) for n in range(40)}
    # The hub of 95 has no node of its own, the others have one or several.
    labels = [3 if n < 6 else 70 if n == 71 else n if n != 95 else 94 for n in range(len(texts))]
    known = [(n, low) for n, low in enumerate(labels) if n != low]
    links, pairs = near_dedup.around_hubs(
        spark.createDataFrame(list(enumerate(texts)), "node long, text string"),
        spark.createDataFrame([(n, labels[n], h) for n, h in placed], "node long, label long, hub long"),
        2,
        80,
    )
    similar = set(similar_sets(texts, 2))
    sure = {tuple(sorted(r)) for r in links.collect()}
    looked_at = {tuple(r) for r in pairs.collect()}
    within = {(u, v) for u, v in similar if any((u, h) in placed and (v, h) in placed for h in hubs)}
    via_centres = joined([*known, *sure, *(similar & looked_at)])
    assert sure and looked_at and sure <= similar
    assert via_centres == joined([*known, *within])
    assert len(looked_at) < len(texts) ** 2 / 10
