"""Connected components of links, by alternating large and small stars.

Each round points every node's larger neighbours, then its smaller ones, to the smallest
node it knows. The links end as stars around the smallest node of each component, after a
number of rounds that grows with the logarithm of the nodes. Minima are staged before they
are joined, so that both sides of each join are shuffled and a hub's links can be split.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.llm.common import drop_staged_table, stage

LARGE = 64
"""Members of a bucket of several components above which it is dealt anew, if there is a finer way."""
SPREAD = 4_096
"""Members of a bucket above which its pairs are made by several tasks, for so many members of one side each."""
HUB_SHARE = 8
"""A component is a large bucket's hub if it has at least one in so many of its members."""
NO_HUB = -1


def _with_smallest(links: DataFrame) -> DataFrame:
    """``links`` (u, v) and the smallest node among u and all its v, as ``low``."""
    minima = links.groupBy("u").agg(F.min("v").alias("low"))
    minima = minima.select(F.col("u").alias("of"), F.least("u", "low").alias("low"))
    return links.join(stage(minima, "minima"), F.col("u") == F.col("of")).drop("of")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    pointed = _with_smallest(both).where("v > u")
    return pointed.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    pointed = _with_smallest(links)
    others = pointed.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    own = pointed.select("u", F.col("low").alias("v"))
    return own.unionByName(others).distinct()


def _fingerprint(links: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (u, v: bigint); label is the smallest node
    of its component. Links may be repeated; self-links and no links give no rows."""
    larger = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stage(larger.distinct(), "links")
    before, after = None, _fingerprint(now)
    while before != after:
        now = stage(_small_star(stage(_large_star(now), "large-star")), "small-star")
        before, after = after, _fingerprint(now)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return nodes.unionByName(centres)


def _sliced(rows: DataFrame, by: Column, slices: int) -> list[DataFrame]:
    """The rows in so many parts by a number or hash."""
    return [rows.where(F.pmod(by, F.lit(slices)) == i) for i in range(slices)] if slices > 1 else [rows]


def shared_buckets(buckets: DataFrame, slices: int = 1) -> DataFrame:
    """The rows of ``buckets`` (key, node) whose key has several nodes, and one of these as
    ``leader``: the least of node XOR key, so that a node meets another leader in each bucket.

    ``slices`` parts by key are made one after the other, so that one of them is shuffled at a time."""
    return reduce(DataFrame.unionByName, map(_shared, _sliced(buckets, F.col("key"), slices)))


def _shared(buckets: DataFrame) -> DataFrame:
    place = F.col("node").bitwiseXOR(F.col("key"))
    ends = buckets.groupBy("key").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    shared = ends.where("low < high").select("key", F.col("low").bitwiseXOR(F.col("key")).alias("leader"))
    shared = stage(shared, "buckets")
    members = stage(buckets.join(shared, "key"), "members")
    drop_staged_table(shared)
    return members


def with_hubs(large: DataFrame) -> DataFrame:
    """(node, label, hub) of the rows (key, node, label) of buckets: the label that most members of a bucket
    have is the hub of all of them, if enough have it; else ``NO_HUB``."""
    sizes = large.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    most = F.max(F.struct("n", "label"))
    hubs = sizes.groupBy("key").agg(most.alias("most"), F.sum("n").alias("members"))
    enough = F.col("most.n") * HUB_SHARE >= F.col("members")
    hubs = hubs.select("key", F.when(enough, F.col("most.label")).otherwise(NO_HUB).alias("hub"))
    return large.join(hubs, "key").select("node", "label", "hub").distinct()


def link_members(
    members: DataFrame,
    marks: DataFrame,
    close: Callable[[Column, Column], Column],
    confirm: Callable[[DataFrame], DataFrame],
    refined: Callable[[DataFrame], DataFrame] | None = None,
    close_refined: Callable[[Column, Column], Column] | None = None,
    finer: Callable[[DataFrame], DataFrame] | None = None,
    known: DataFrame | None = None,
    around: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
    slices: int = 1,
    bands: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """(node, label) of the linked nodes of ``members`` (key, node, leader).

    ``marks`` (node, mark) has a mark of each node; a pair is looked at where ``close`` holds
    for the marks, and linked where ``confirm``, given pairs (u, v), returns it.

    First every member meets its leader. Then, in buckets whose members are still in
    several components, pairs across components meet, which cannot miss a link that joins
    two components. A bucket of copies takes one comparison per member. For that second
    step, ``refined`` may give the nodes that are left marks of another kind.

    Buckets of more than ``LARGE`` members that are still in several components are not
    expanded into pairs where ``finer`` is given: it deals their nodes (node) to other buckets, as
    members, in which all pairs that can be linked must meet again, and these are linked in the same
    way. So many unlike nodes in one bucket cost what their finer buckets do. ``known`` (node,
    label) are components found before, whose nodes need not meet each other.

    Finer buckets can be large too, where nodes are much alike but not all linked. With ``around`` these
    are not expanded either: given (node, label, hub) it returns links (u, v), and the pairs
    (u, v) to confirm, that together join all linked nodes with a hub in common.

    Buckets of more than ``SPREAD`` members that are expanded are so in several tasks; with ``bands``, a number
    for a mark that differs by 1 at most where marks are close, only between neighbouring bands.

    The rows of buckets take their marks along. In ``slices`` parts, one after the other, fewer of
    them are on disk at a time; the pairs are the same.
    """
    links, found = _linked(
        members, marks, close, confirm, refined, close_refined, finer, known, around, slices, bands
    )
    return found if found is not None else stage(components(links), "components")


def _linked(
    members: DataFrame,
    marks: DataFrame,
    close: Callable[[Column, Column], Column],
    confirm: Callable[[DataFrame], DataFrame],
    refined: Callable[[DataFrame], DataFrame] | None,
    close_refined: Callable[[Column, Column], Column] | None,
    finer: Callable[[DataFrame], DataFrame] | None,
    known: DataFrame | None,
    around: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None,
    slices: int = 1,
    bands: Callable[[Column], Column] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """The links (u, v) of ``link_members``, and their components if these are found already."""
    stars = members.where("node <> leader").select("leader", "node").distinct()
    if known is not None:
        for side in ("leader", "node"):
            named = known.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
            stars = stars.join(named, side, "left")
            stars = stars.withColumn(f"label_{side}", F.coalesce(f"label_{side}", side))
        stars = stars.where("label_leader <> label_node").select("leader", "node")
    looked = []
    for part in _sliced(stars, F.xxhash64("leader", "node"), slices):
        part = part.join(marks.withColumnRenamed("mark", "mark_v"), "node").withColumnRenamed("node", "v")
        part = part.join(marks, F.col("leader") == F.col("node"))
        part = part.where(close(F.col("mark"), F.col("mark_v")))
        looked.append(stage(part.select(F.col("leader").alias("u"), "v"), "stars"))
    stars = reduce(DataFrame.unionByName, looked)
    links = confirm(stars)
    if known is not None:
        links = links.unionByName(known.selectExpr("node AS u", "label AS v"))
    links = stage(links, "links")
    first = stage(components(links), "components")

    labelled = members.join(first, "node", "left")
    labelled = stage(labelled.select("key", "node", F.coalesce("label", "node").alias("label")), "labelled")
    ends = (F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("members"))
    mixed = stage(labelled.groupBy("key").agg(*ends).where("low < high").select("key", "members"), "mixed")
    apart = stage(labelled.join(mixed, "key"), "apart")
    drop_staged_table(labelled)
    if refined is not None:
        marks, close = stage(refined(apart.select("node").distinct()), "marks"), close_refined
    meets = F.lit(True)
    sure = near = None
    if finer is not None or around is not None:
        large = stage(apart.where(F.col("members") > LARGE).select("key", "node", "label"), "large")
        apart = apart.where(F.col("members") <= LARGE)
        if large.isEmpty():
            pass
        elif finer is not None:
            nodes = large.select("node").distinct()
            links, first = _linked(
                finer(nodes), marks, close, confirm, None, None, None, known=first, around=around
            )
        else:
            placed = stage(with_hubs(large), "placed")
            sure, near = around(placed)
            # Who has a hub in common has met there.
            hubs = placed.groupBy("node").agg(F.collect_set("hub").alias("hubs"))
            apart = apart.join(hubs, "node", "left")
            met = F.arrays_overlap("hubs_u", "hubs_v")
            meets = ~F.coalesce(met, F.lit(False))
    met = []
    # What is dealt anew leaves no large bucket.
    if finer is not None or around is not None or mixed.where(F.col("members") > SPREAD).isEmpty():
        apart = apart.drop("members")
    for part in _sliced(apart, F.col("key"), slices):
        marked = stage(part.join(marks, "node"), "marked")
        pairs = _across(marked, meets, close, bands)
        if slices > 1:
            pairs = stage(pairs.distinct(), "met")
            drop_staged_table(marked)
        met.append(pairs)
    pairs = reduce(DataFrame.unionByName, met)
    # Once, however many keys they share.
    if near is not None:
        pairs = pairs.unionByName(near)
    pairs = stage(pairs.distinct().join(stars, ["u", "v"], "left_anti"), "pairs")
    for done in met if slices > 1 else [marked]:
        drop_staged_table(done)
    if slices > 1:
        parts = _sliced(pairs, F.xxhash64("u", "v"), slices)
        more = reduce(DataFrame.unionByName, [stage(confirm(part), "confirmed") for part in parts])
    else:
        more = confirm(pairs)
    more = stage(more if sure is None else more.unionByName(sure), "links")
    return (links, first) if more.isEmpty() else (links.unionByName(more), None)


def _dealt(marked: DataFrame, bands: Callable[[Column], Column] | None) -> tuple[DataFrame, DataFrame]:
    """``marked`` twice, with the columns share and band: each two rows of a bucket whose bands are neighbours have
    both in common once. Rows of large buckets are in one share on one side, in all on the other."""
    large = F.col("members") > SPREAD
    shares = F.ceil(F.col("members") / SPREAD)
    none = F.lit(0).cast("bigint")
    band = none if bands is None else F.when(large, bands(F.col("mark")).cast("bigint")).otherwise(none)
    share = F.when(large, F.pmod(F.xxhash64("node"), shares)).otherwise(none)
    one = marked.select("*", share.alias("share"), band.alias("band"))
    every = F.when(large, F.sequence(none, shares - 1)).otherwise(F.array(none))
    away = F.array(none) if bands is None else F.when(large, F.sequence(none - 1, none + 1)).otherwise(F.array(none))
    other = marked.select("*", F.explode(every).alias("share"))
    other = other.select("*", F.explode(away).alias("away"))
    return one, other.withColumn("band", band + F.col("away")).drop("away")


def _across(
    marked: DataFrame,
    meets: Column,
    close: Callable[[Column, Column], Column],
    bands: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The pairs (u, v) of ``marked`` (key, node, label, mark, ...) of one bucket and two components whose marks
    are close; ``meets`` is a condition of the caller's on the columns of both sides."""
    both = _dealt(marked, bands) if "members" in marked.columns else (marked, marked)
    sides = [
        rows.select(*[F.col(c).alias(f"{c}_{side}") for c in rows.columns])
        for rows, side in zip(both, ("u", "v"))
    ]
    if "members" in marked.columns:
        meets &= (F.col("share_u") == F.col("share_v")) & (F.col("band_u") == F.col("band_v"))
    meets = (
        (F.col("key_u") == F.col("key_v"))
        & (F.col("label_u") < F.col("label_v"))
        & meets
        & close(F.col("mark_u"), F.col("mark_v"))
    )
    pairs = sides[0].join(sides[1], meets)
    return pairs.select(F.least("node_u", "node_v").alias("u"), F.greatest("node_u", "node_v").alias("v"))
