"""Parent-child links to full hierarchies.

Nodes whose hash falls under a threshold are splitters, and so is every root. All inner nodes walk along their parents
to the next splitter, the pointers among splitters are solved by doubling, and the walks are put before the solved
paths. A round in which no walk ends proves that the rest never ends: what is left are rings (or leads into one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.runtime import BROADCAST_BYTES, estimated_bytes, lookup_join, staged

#: One node in so many is a splitter; steps of a walk between two stagings.
SPLITTER_ONE_IN = 4
STEPS_A_ROUND = 3


def _array(with_paths: bool, *cols):
    return F.concat(*cols) if with_paths else F.lit(None).cast("array<long>")


def resolve_hierarchy(links: DataFrame, *, with_paths: bool = True, one_in: int = SPLITTER_ONE_IN, steps: int = STEPS_A_ROUND) -> DataFrame:
    """(node, root, depth, path) of every node of ``links`` (node, parent), both longs.

    A parent that is no node itself, or null, makes the node a root: depth 0, path [root]. ``path`` runs from the
    node to its root. Nodes in a ring or leading into one have root, depth and path null. Repeated rows count once;
    of several parents of a node the smallest counts. ``with_paths`` False leaves path null and keeps rows small.
    """
    nodes = staged(links.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("parent").alias("parent")))
    ids = nodes.select(F.col("node").alias("pid"))

    # Parents that are no node end the tree. Only inner nodes (those with a child) take part in the walks.
    inner_ids = nodes.filter(F.col("parent").isNotNull()).select(F.col("parent").alias("node")).distinct()
    tree = nodes.join(inner_ids, "node", "left_semi")
    up = lookup_join(tree, ids, "parent", "pid", "left").select("node", F.col("pid").alias("parent"))
    is_split = F.col("parent").isNull() | (F.pmod(F.xxhash64("node", F.lit(5)), F.lit(one_in)) == 0)
    up = staged(up.withColumn("split", is_split))
    table = up.select(F.col("node").alias("at"), F.col("parent").alias("next"), F.col("split").alias("at_split"))

    # A walk: start, the node it stands at, steps made and nodes passed (start included, the end not).
    walks = up.filter(F.col("parent").isNotNull()).select(F.col("node").alias("start"), F.col("parent").alias("cur"), F.lit(1).alias("len"), _array(with_paths, F.array("node")).alias("way"))
    broadcast = estimated_bytes(table) <= BROADCAST_BYTES  # else every look-up counts the hot keys of what it gets, which must stand by then
    done, left = [], -1
    while True:
        for _ in range(steps):
            moved = lookup_join(walks, table, "cur", "at", "inner")
            on = ~F.col("at_split") if "ended" not in walks.columns else ~F.col("at_split") & ~F.col("ended")
            walks = moved.select(
                "start",
                F.when(on, F.col("next")).otherwise(F.col("cur")).alias("cur"),
                (F.col("len") + F.when(on, 1).otherwise(0)).alias("len"),
                _array(with_paths, F.col("way"), F.when(on, F.array("cur")).otherwise(F.array().cast("array<long>"))).alias("way"),
                (~on).alias("ended"),
            )
            walks = walks if broadcast else staged(walks)
        walks = staged(walks) if broadcast else walks
        now = walks.filter(~F.col("ended")).count()
        done.append(walks.filter("ended").drop("ended"))
        if now == 0 or now == left:
            break
        left, walks = now, walks.filter(~F.col("ended"))
    arrived = done[0]
    for d in done[1:]:
        arrived = arrived.unionByName(d)

    # Reduced pointers among splitters: roots point nowhere.
    roots = up.filter(F.col("parent").isNull()).select("node")
    reduced = arrived.join(up.filter("split").select(F.col("node").alias("start")), "start", "left_semi")
    is_root = roots.select(F.col("node").alias("rid"))
    point = lookup_join(reduced, is_root, "cur", "rid", "left").select(F.col("start").alias("s"), F.col("cur").alias("t"), "len", "way", F.col("rid").isNotNull().alias("fin"))
    point = staged(point)
    left = point.filter(~F.col("fin")).count()
    while left:
        ahead = point.select(F.col("s").alias("s2"), F.col("t").alias("t2"), F.col("len").alias("len2"), F.col("way").alias("way2"), F.col("fin").alias("fin2"))
        open_ = lookup_join(point.filter(~F.col("fin")), ahead, "t", "s2", "inner").select("s", F.col("t2").alias("t"), (F.col("len") + F.col("len2")).alias("len"), _array(with_paths, F.col("way"), F.col("way2")).alias("way"), F.col("fin2").alias("fin"))
        point = staged(point.filter("fin").unionByName(open_))
        now = point.filter(~F.col("fin")).count()
        if now == left:
            break
        left = now

    solved = point.filter("fin").select("s", F.col("t").alias("root"), F.col("len").alias("more"), F.col("way").alias("rest"))
    solved = solved.unionByName(roots.select(F.col("node").alias("s"), F.col("node").alias("root"), F.lit(0).alias("more"), _array(with_paths, F.array().cast("array<long>")).alias("rest")))
    own = arrived.join(up.filter("split").select(F.col("node").alias("start")), "start", "left_anti")
    inner = lookup_join(own, solved, "cur", "s", "inner").select(F.col("start").alias("n"), "root", (F.col("len") + F.col("more")).alias("depth"), _array(with_paths, F.col("way"), F.col("rest")).alias("way"))
    inner = inner.unionByName(solved.select(F.col("s").alias("n"), "root", F.col("more").alias("depth"), F.col("rest").alias("way")))
    inner = staged(inner)

    # Leaves hang under a solved inner node, or are roots themselves.
    leaves = nodes.join(inner_ids, "node", "left_anti")
    leaf = lookup_join(lookup_join(leaves, ids, "parent", "pid", "left").select("node", F.col("pid").alias("parent")), inner, "parent", "n", "left")
    alone = F.col("parent").isNull()
    leaf = leaf.select(
        "node",
        F.when(alone, F.col("node")).otherwise(F.col("root")).alias("root"),
        F.when(alone, F.lit(0)).otherwise(F.col("depth") + 1).alias("depth"),
        F.when(alone, F.array().cast("array<long>")).otherwise(F.concat(F.array("node"), F.col("way"))).alias("way"),
    )
    rest = up.select("node").join(inner.select(F.col("n").alias("node"), "root", "depth", "way"), "node", "left")
    out = leaf.unionByName(rest)
    path = F.concat("way", F.array("root")) if with_paths else F.lit(None).cast("array<long>")
    return out.select("node", "root", F.col("depth").cast("int").alias("depth"), F.when(F.col("root").isNotNull(), path).alias("path"))


def descendants(hierarchy: DataFrame) -> DataFrame:
    """(ancestor, descendant, distance) of every pair on a path, distance 1 and more."""
    pairs = hierarchy.filter(F.col("path").isNotNull()).select(F.col("node").alias("descendant"), F.posexplode("path").alias("distance", "ancestor"))
    return pairs.filter("distance > 0").select("ancestor", "descendant", "distance")
