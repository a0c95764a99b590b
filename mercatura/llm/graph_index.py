"""Approximate nearest neighbours by inner product: a pruned directed graph per shard.

Equal vectors are one node that carries its smallest ids, so groups of copies neither fill
a graph nor a result. Nodes are dealt to shards of about ``SHARD_ROWS`` by a hash, which
bounds the memory of a task. A shard's graph grows in batches: a greedy search from the
entry node proposes neighbours of each new node, pruning keeps the nearest one and
drops those that it, or an edge kept later, is nearer to by the factor ``RELAX``, and edges back
are pruned alike. Queries, in blocks, search every shard with a beam; the best of all shards
are a query's result, scored in double precision on the original vectors.

For the largest inner product, every vector gets one more component that brings all to one
length; nearest in distance is then largest in product.

Defined results: rows without an id, and vectors that are null, empty, zero, or hold null or
non-finite components take no part; nor do vectors whose length is not the most frequent one (the larger, in
a tie). A row given twice counts once. A query's own id is never its neighbour, and fewer
than ``k`` candidates are all returned. No vectors give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.llm.common import stage

SHARD_ROWS = 8_192
BLOCK_ROWS = 2_048
DEGREE = 32
BUILD_BEAM = 64
QUERY_BEAM = 128
RELAX = 1.2
BATCH = 512
EXPANDED = 4
"""Nodes of a beam that are opened at once."""


def takes_part(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows a (n, d) to their own rows b (n, k, d)."""
    return ((a[:, None, :] - b) ** 2).sum(-1)


def prune(x: np.ndarray, of: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of the nodes ``of`` among ``candidates``, -1 for none.

    Nearest first; an edge drops every later candidate that is nearer to its end, by the factor
    RELAX, than to the node itself.
    """
    candidates = np.where(candidates == of[:, None], -1, candidates)
    points = x[candidates]
    far = np.where(candidates < 0, np.inf, _distances(x[of], points))
    order = np.argsort(far, axis=1, kind="stable")
    candidates = np.take_along_axis(candidates, order, 1)
    far = np.take_along_axis(far, order, 1)
    points = np.take_along_axis(points, order[:, :, None], 1)
    alive = np.isfinite(far)
    alive[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    rows = np.arange(len(of))
    kept = np.full((len(of), degree), -1, np.int32)
    for place in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        best = alive.argmax(axis=1)
        kept[:, place] = np.where(some, candidates[rows, best], -1)
        between = _distances(points[rows, best], points)
        alive &= (RELAX * RELAX * between > far) & some[:, None]
        alive[rows, best] = False
    return kept


def search(
    x: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int, product: bool
) -> np.ndarray:
    """The beam of each query at the end: ids, nearest first, -1 where there are fewer.

    Nearness is the largest inner product or the smallest distance.
    """

    def cost(ids: np.ndarray) -> np.ndarray:
        points = x[ids]
        if product:
            return -np.einsum("bd,bkd->bk", queries, points)
        return _distances(queries, points)

    n = len(queries)
    rows = np.arange(n)[:, None]
    ids = np.full((n, beam), -1, np.int64)
    ids[:, 0] = entry
    costs = np.full((n, beam), np.inf)
    costs[:, :1] = cost(ids[:, :1])
    opened = np.zeros((n, beam), bool)
    seen = np.zeros((n, len(x) + 1), bool)  # the last column stands for -1
    seen[:, entry] = seen[:, -1] = True
    while True:
        closed = np.where(opened | (ids < 0), np.inf, costs)
        best = np.argsort(closed, axis=1, kind="stable")[:, :EXPANDED]
        open_now = np.isfinite(np.take_along_axis(closed, best, 1))
        if not open_now.any():
            return ids
        opened[rows, best] |= open_now
        nodes = np.where(open_now, np.take_along_axis(ids, best, 1), -1)
        found = np.where(nodes[:, :, None] < 0, -1, graph[nodes]).reshape(n, -1)
        found = np.where(seen[rows, found], -1, found)
        found.sort(axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        seen[rows, found] = True
        new_costs = np.where(found < 0, np.inf, cost(found))
        ids = np.concatenate([ids, found], axis=1)
        costs = np.concatenate([costs, new_costs], axis=1)
        opened = np.concatenate([opened, np.zeros(found.shape, bool)], axis=1)
        order = np.argsort(costs, axis=1, kind="stable")[:, :beam]
        ids, costs, opened = (np.take_along_axis(a, order, 1) for a in (ids, costs, opened))


def _back_edges(x: np.ndarray, graph: np.ndarray, sources: np.ndarray, kept: np.ndarray) -> None:
    """Adds the edges from the ends of new edges back to ``sources``, pruned where too many."""
    degree = graph.shape[1]
    ends = kept.ravel()
    starts = np.repeat(sources, kept.shape[1])[ends >= 0]
    ends = ends[ends >= 0]
    order = np.lexsort((((x[ends] - x[starts]) ** 2).sum(-1), ends))
    ends, starts = ends[order], starts[order]
    nodes, first, count = np.unique(ends, return_index=True, return_counts=True)
    for width in np.unique(np.minimum(count, 3 * degree)):
        chosen = np.flatnonzero(np.minimum(count, 3 * degree) == width)
        for part in np.array_split(chosen, max(1, len(chosen) // 1024)):
            at = nodes[part]
            new = starts[first[part][:, None] + np.arange(width)]
            graph[at] = prune(x, at, np.concatenate([graph[at], new], axis=1), degree)


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> tuple[np.ndarray, int]:
    """The graph of the points ``x`` (one row of neighbours per point) and its entry node."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int32)
    entry = int(((x - x.mean(0)) ** 2).sum(-1).argmin())
    order = np.random.default_rng(11).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    done = min(n, degree)
    first = order[:done]
    everyone = np.broadcast_to(first, (done, done))
    graph[first] = prune(x, first, everyone.astype(np.int64), degree)
    while done < n:
        batch = order[done : done + min(done, BATCH)]
        proposed = search(x, graph, entry, x[batch], beam, product=False)
        kept = prune(x, batch, proposed, degree)
        graph[batch] = kept
        _back_edges(x, graph, batch, kept)
        done += len(batch)
    return graph, entry


def _nodes(vectors: DataFrame, k: int) -> DataFrame:
    """(vector, ids): distinct vectors with their k + 1 smallest ids, one more than a result
    can need, as a query is not its own neighbour."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    first = vectors.withColumn("place", place).where(F.col("place") <= k + 1)
    return first.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


_SHARD = "shard int, entry int, points binary, graph binary, ids binary, n_ids binary"


def _shards(nodes: DataFrame, longest: float) -> DataFrame:
    """One row per shard: its points, graph and ids."""

    def make(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["vector"].to_numpy())
        rest = np.sqrt(np.maximum(0.0, longest**2 - (x**2).sum(1)))
        graph, entry = build(np.column_stack([x, rest]).astype(np.float32))
        ids = np.concatenate(rows["ids"].to_numpy()).astype(np.int64)
        return pd.DataFrame(
            {
                "shard": [int(rows["shard"].iloc[0])],
                "entry": [entry],
                "points": [x.tobytes()],
                "graph": [graph.tobytes()],
                "ids": [ids.tobytes()],
                "n_ids": [rows["ids"].map(len).to_numpy(np.int64).tobytes()],
            }
        )

    return nodes.groupBy("shard").applyInPandas(make, _SHARD)


def _search_shard(row, k: int) -> pd.DataFrame:
    """The k best of one shard for each query of one block."""
    queries = np.stack([q["vector"] for q in row.queries])
    query_ids = np.array([q["vec_id"] for q in row.queries])
    x = np.frombuffer(row.points).reshape(-1, queries.shape[1])
    graph = np.frombuffer(row.graph, np.int32).reshape(len(x), -1)
    ends = np.cumsum(np.frombuffer(row.n_ids, np.int64))
    ids = np.frombuffer(row.ids, np.int64)
    out: list[tuple] = []
    points = x.astype(np.float32)
    for at in range(0, len(queries), 256):
        part = queries[at : at + 256]
        found = search(points, graph, row.entry, part.astype(np.float32), QUERY_BEAM, product=True)
        for query_id, query, nodes in zip(query_ids[at : at + 256], part, found):
            nodes = nodes[nodes >= 0]
            scores = x[nodes] @ query
            best = np.argsort(-scores, kind="stable")[: k + 1]
            made = [
                (-scores[b], vec_id)
                for b in best
                for vec_id in ids[(ends[nodes[b] - 1] if nodes[b] else 0) : ends[nodes[b]]].tolist()
                if vec_id != query_id
            ]
            out += [(query_id, vec_id, -score) for score, vec_id in sorted(made)[:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """For the rows of ``vectors`` (vec_id, embedding) chosen by ``queries``: query_id, rank,
    vec_id, score of the k nearest found."""
    spark = vectors.sparkSession
    valid = vectors.where(F.col("vec_id").isNotNull() & takes_part(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("vector"),
        queries.alias("asks"),
    )
    size = F.size("vector")
    usual = valid.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if usual is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    valid = valid.where(size == usual.d).dropDuplicates(["vec_id", "vector"])
    valid = stage(valid, "vectors")
    nodes = stage(_nodes(valid, k), "nodes")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    count, longest = nodes.agg(F.count(F.lit(1)), F.max(norm)).first()
    shards = -(-count // SHARD_ROWS)
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))
    index = stage(_shards(dealt, longest), "index")

    asking = valid.where("asks")
    blocks = max(1, -(-asking.count() // BLOCK_ROWS))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    asked = asking.groupBy(block.alias("block")).agg(
        F.collect_list(F.struct("vec_id", "vector")).alias("queries")
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    pairs = asked.select("block", "queries", every).join(index, "shard")
    pairs = pairs.repartition(shards * blocks, "shard", "block")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                yield _search_shard(row, k)

    found = pairs.mapInPandas(run, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = ranked.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
