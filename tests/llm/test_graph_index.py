"""Neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercatura.llm import graph_index
from mercatura.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, rank int"


def exact(vectors, query_id, k):
    """The k best other ids of {id: vector}."""
    query = vectors[query_id]
    scored = sorted((-float(np.dot(v, query)), i) for i, v in vectors.items() if i != query_id)
    return [i for _, i in scored[:k]]


def recall(rows, vectors, k):
    found = {}
    for r in rows:
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    right = 0
    for query_id, got in found.items():
        assert sorted(got) == list(range(1, len(got) + 1))
        ordered = [got[i] for i in sorted(got)]
        assert ordered == sorted(ordered, key=lambda p: (-p[1], p[0]))
        for vec_id, score in ordered:
            assert vec_id != query_id
            assert score == pytest.approx(float(np.dot(vectors[vec_id], vectors[query_id])), abs=1e-12)
        right += len({i for i, _ in ordered} & set(exact(vectors, query_id, k)))
    return right / (k * len(found)), found


def test_query_recall(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    vectors = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in table}
    rate, found = recall(QUERIES["op9_graph_neighbours"](spark, SMALL).collect(), vectors, 20)
    assert set(found) == {i for i in vectors if i % 20 == 0} and rate >= 0.95


def test_recall_with_many_shards_blocks_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(graph_index, "SHARD_ROWS", 700)
    monkeypatch.setattr(graph_index, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 3000)] + 0.4 * rng.normal(size=(3000, 16))
    x = (x * rng.uniform(0.5, 2.0, (3000, 1))).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = graph_index.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, 20)
    rate, found = recall(got.collect(), dict(enumerate(x.astype(np.float64))), 20)
    assert len(found) == 150 and rate >= 0.9


def test_copies_nulls_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], 0) for i in range(50)] + [(100, [0.0, 1.0], 0), (101, [2.0, 2.0], 0)]
    bad = [None, [], [0.0, 0.0], [None, 1.0], [nan, 1.0], [inf, 1.0], [1.0, 2.0, 3.0]]
    rows += [(200 + 20 * i, v, 0) for i, v in enumerate(bad)]
    rows += [(None, [1.0, 1.0], 0), (20, [1.0, 0.0], 5)]
    got = graph_index.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, 20).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by_query.setdefault(r.query_id, []).append(r.vec_id)
    assert set(by_query) == {0, 20, 40, 100}
    assert by_query[0] == [101, *range(1, 20)] and by_query[20] == [101, *range(19)]
    assert by_query[40] == [101, *range(19)] and by_query[100][0] == 101

    few = spark.createDataFrame(rows[:3], SCHEMA)
    assert [r.vec_id for r in graph_index.nearest(few, F.col("vec_id") == 0, 20).collect()] == [1, 2]
    assert graph_index.nearest(few.limit(0), F.col("vec_id") == 0).count() == 0
    assert graph_index.nearest(few.limit(1), F.col("vec_id") == 0).count() == 0
