"""Clusters by bit planes against plain whole-number arithmetic."""

import hashlib
import random

import numpy as np
import pytest

from mercatura.llm import bit_planes
from mercatura.llm.registry import QUERIES

SCHEMA = "vec_id long, embedding array<double>, cluster int, planes string"


def brute_force(rows, clusters=8, rounds=10, scale=1024):
    """[(vec_id, cluster, distance, centroid)] by the definition, in Python integers."""
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == 64 and all(x is not None and np.isfinite(x) for x in vector):
            kept.append((vec_id, [int(np.floor(scale * x)) for x in vector]))
    order = sorted(
        kept,
        key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]),
    )
    centroids = [list(v) for _, v in order[:clusters]]

    def assign():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            members = [v for (_, v), (at, _) in zip(kept, found) if at == c]
            if members:
                centroids[c] = [sum(column) // len(members) for column in zip(*members)]
    return sorted(
        (str(vec_id), at, far, tuple(centroids[at])) for (vec_id, _), (at, far) in zip(kept, assign())
    )


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA).repartition(3)
    return sorted(
        (str(r.vec_id), r.cluster, r.distance, tuple(r.centroid))
        for r in bit_planes.cluster(table, **options).collect()
    )


def vectors(seed, count, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) + 2 * (i % 3) for _ in range(64)]) for i in range(count)]


def test_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for least, most in ((-1024, 1024), (-1, 0), (0, 1), (-(2**27), 2**27 - 1), (5, 9), (0, 0)):
        count = bit_planes.digits(least, most)
        a, b = (rng.integers(least, most + 1, (n, 64)) for n in (7, 5))
        a[0], b[0] = least, most
        pa, pb = bit_planes.planes(a, count), bit_planes.planes(b, count)
        assert (bit_planes.dots(pa, pb) == a @ b.T).all()
        assert (bit_planes.squares(pa) == (a * a).sum(1)).all()
        assert (bit_planes.component_sums(pa) == a.sum(0)).all()


def test_clusters_equal_brute_force(spark):
    rows = vectors(2, 200)
    assert found(spark, rows) == brute_force(rows)


def test_odd_vectors_and_ids(spark):
    rows = vectors(3, 30, 0.1)
    rows += [(100, None), (101, []), (102, [0.5] * 63), (103, [0.5] * 65), (104, [None] + [0.5] * 63)]
    rows += [(105, [float("nan")] + [0.5] * 63), (106, [float("-inf")] + [0.5] * 63)]
    rows += [(None, [0.25] * 64), (None, [-0.25] * 64), (7, [-3.0] * 64), (7, [-3.0] * 64), (200, [0.0] * 64)]
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, rows, clusters=3, rounds=2, scale=10) == brute_force(rows, 3, 2, 10)


def test_equal_vectors_few_vectors_and_none(spark):
    same = [(i, [0.5] * 64) for i in range(40)]
    assert found(spark, same) == brute_force(same)
    assert {r[1] for r in found(spark, same)} == {0}
    few = vectors(4, 3)
    assert found(spark, few) == brute_force(few)
    assert found(spark, [(1, None)]) == [] and found(spark, []) == []


def test_components_too_large_are_an_error(spark):
    with pytest.raises(ValueError, match="digits"):
        found(spark, [(1, [1e9] * 64)])


def test_query_and_inertia(spark, tmp_path):
    rows = vectors(5, 60)
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op11_bit_plane_clusters"](spark, str(tmp_path)).collect()
    expected = brute_force(rows)
    total = sum(far for _, _, far, _ in expected)
    for r in got:
        same = [far for _, at, far, _ in expected if at == r.cluster]
        assert (r.cluster_inertia, r.inertia) == (sum(same), total)
        centroid = next(c for i, _, _, c in expected if i == str(r.vec_id))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
    assert len(got) == len(expected)
