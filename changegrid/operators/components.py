"""Connected components of an edge list, by alternating neighbour minima and pointer jumps.

Every round is a few equi-joins and aggregates on tables that were just read from the shared folder, so
adaptive execution can split hot keys, and lineage stays one round long.  The driver sees only counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changegrid.sources.staging import stage


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 64) -> DataFrame:
    """Smallest node reachable from every node that occurs in ``edges``.

    Returns ``(node, component)``.  Edges are undirected; loops, repeats and nulls are ignored, and
    isolated nodes do not appear (their component is themselves).  Works on any orderable node type.

    Contracting rounds: each node points at whichever of itself and its neighbours has the lowest hash,
    pointers are jumped once, and the edges are rewritten between the nodes pointed at.  Hashes put the
    nodes in random order, so the number of nodes falls geometrically, also on long sorted chains.
    """
    e = (
        edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    e = stage(e, "cc-edges")
    maps = []  # node -> pointer, one table a round, over the nodes that still had edges
    for _ in range(max_rounds):
        if e.isEmpty():
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("n")))
        near = both.groupBy(F.col("a").alias("node")).agg(low.alias("low"))
        own = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("n"))
        near = stage(near.select("node", F.least("low", own)["n"].alias("ptr")), "cc-near")
        jump = near.select(F.col("node").alias("ptr"), F.col("ptr").alias("next"))
        ptr = stage(near.join(jump, "ptr").select("node", F.col("next").alias("ptr")), "cc-ptr")
        maps.append(ptr)
        pa = ptr.select(F.col("node").alias("a"), F.col("ptr").alias("pa"))
        pb = ptr.select(F.col("node").alias("b"), F.col("ptr").alias("pb"))
        half = stage(e.join(pa, "a").select("pa", "b"), "cc-half")
        new = half.join(pb, "b").where("pa != pb")
        e = stage(new.select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct(), "cc-edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if not maps:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # A node of round k points at a node that round k+1 moves on, or that has no edges left.
    out = maps[-1]
    for ptr in reversed(maps[:-1]):
        later = out.select(F.col("node").alias("ptr"), F.col("ptr").alias("next"))
        out = stage(ptr.join(later, "ptr", "left").select("node", F.coalesce("next", "ptr").alias("ptr")), "cc-map")
    least = stage(out.groupBy("ptr").agg(F.min("node").alias("component")), "cc-least")
    return out.join(least, "ptr").select("node", "component")
