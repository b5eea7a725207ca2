"""Outlines of unions of equal discs: the arcs of each circle that no other disc covers.

A disc within two radii covers an arc of a circle; sorted by their beginnings, the covered arcs leave gaps, which are the
union's border.  Area and perimeter are sums over gaps (Green's theorem); rings link each arc to the one that starts where it ends.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changegrid.operators.chains import rank_cycles
from changegrid.sources.staging import stage

#: Discs in a cell of a quarter radius beyond which those covered by the cells' outermost discs are first dropped, and
#: the number of directions in which a disc can be outermost, round by round.
CROWDED, DIRECTIONS = 64, (16, 64, 256)
#: Arcs shorter than EPS radians are points; ends nearer than NEAR radii are one point.
EPS, NEAR = 1e-9, 1e-6
TURN = 2 * math.pi


def _around(discs: DataFrame, others: DataFrame, by: list[str], cell: float) -> DataFrame:
    """Pairs of different discs in the same or neighbouring cells; those of ``others`` are named ``ox``, ``oy``."""
    at = {"_cx": F.floor(F.col("x") / cell), "_cy": F.floor(F.col("y") / cell)}
    step = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    sent = discs.withColumns(at).withColumn("_s", step).withColumns({"_cx": F.col("_cx") + F.col("_s.a"), "_cy": F.col("_cy") + F.col("_s.b")}).drop("_s")
    held = others.withColumns(at).select(*by, "_cx", "_cy", F.col("x").alias("ox"), F.col("y").alias("oy"))
    return sent.join(held, [*by, "_cx", "_cy"]).where((F.col("x") != F.col("ox")) | (F.col("y") != F.col("oy"))).drop("_cx", "_cy")


def _gaps(discs: DataFrame, others: DataFrame, radius: float, by: list[str], cell: float) -> DataFrame:
    """``(*by, id, x, y, a0, a1)``: the arcs, from angle to angle within a turn, that ``others`` leave of each disc's circle."""
    own = [*by, "id", "x", "y"]
    d = F.hypot(F.col("ox") - F.col("x"), F.col("oy") - F.col("y"))
    met = _around(discs, others, by, cell).where(d < 2 * radius * (1 - 1e-12))
    begin = F.atan2(F.col("oy") - F.col("y"), F.col("ox") - F.col("x")) - F.acos(d / (2 * radius))
    covered = met.select(*own, (begin - TURN * F.floor(begin / TURN)).alias("lo"), (2 * F.acos(d / (2 * radius))).alias("width"))
    arc = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    turn, end = F.lit(TURN), F.col("lo") + F.col("width")
    parts = F.when(end > turn, F.array(arc(F.col("lo"), turn), arc(F.lit(0.0), end - turn))).otherwise(F.array(arc(F.col("lo"), end)))
    arcs = covered.select(*own, F.explode(parts).alias("c")).select(*own, "c.*")
    last = discs.select(*own, turn.alias("lo"), turn.alias("hi"))
    order = Window.partitionBy(*by, "id").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("hi").over(order), F.lit(0.0))
    return arcs.unionByName(last).withColumn("a0", reach).where(F.col("lo") > F.col("a0") + EPS).select(*own, "a0", F.col("lo").alias("a1"))


def _thinned(discs: DataFrame, radius: float, by: list[str]) -> DataFrame:
    """The discs without those that the outermost of crowded cells cover; the union is the same."""
    cell = radius / 4
    places = [F.floor(F.col(c) / cell).alias(f"_{c}") for c in "xy"]
    for directions in DIRECTIONS:
        most = discs.groupBy(*by, *places).count().agg(F.max("count")).first()[0] or 0
        if most <= CROWDED:
            break
        angles = [TURN * k / directions for k in range(directions)]
        far = [F.max_by(F.struct("id", "x", "y"), F.col("x") * math.cos(a) + F.col("y") * math.sin(a)) for a in angles]
        outer = discs.groupBy(*by, *places).agg(F.array_distinct(F.array(*far)).alias("far")).select(*by, F.explode("far").alias("f")).select(*by, "f.*")
        outer = stage(outer, "disc-outer")
        # outermost discs stay, so what they cover is covered by discs that stay
        rest = discs.join(outer.select("id"), "id", "left_anti")
        bare = _gaps(rest, outer, radius, by, cell).select("id").distinct()
        discs = stage(outer.unionByName(rest.join(bare, "id", "left_semi")), "disc-thinned")
    return discs


def border_arcs(points: DataFrame, radius: float, by: list[str]) -> DataFrame:
    """``(*by, id, x, y, a0, a1)``: the border of the union of the discs about ``points``, as arcs of their circles.

    Points at one place are one disc.  Missing coordinates have none.
    """
    discs = stage(points.where("x IS NOT NULL AND y IS NOT NULL").select(*by, "x", "y").distinct(), "discs")
    discs = stage(discs.withColumn("id", F.monotonically_increasing_id()), "disc-ids")
    held = _thinned(discs, radius, by)
    return stage(_gaps(held, held, radius, by, 2 * radius), "disc-arcs")


def _ring_places(arcs: DataFrame, radius: float, by: list[str]) -> DataFrame:
    """The arcs with ``ring`` and ``place``.  Where several leave a point, the first clockwise from the way back follows."""
    arcs = stage(arcs.withColumn("arc", F.monotonically_increasing_id()), "arc-ids")
    end = lambda a: {c: F.col(c) + radius * f(F.col(a)) for c, f in (("x", F.cos), ("y", F.sin))}
    cell = 4 * NEAR * radius
    leave = arcs.select(*by, F.col("arc").alias("next"), F.col("a0").alias("s"), *[v.alias(f"s{c}") for c, v in end("a0").items()])
    leave = leave.withColumns({f"_{c}": F.floor(F.col(f"s{c}") / cell) for c in "xy"})
    come = arcs.select(*by, "arc", "a1", *[v.alias(f"e{c}") for c, v in end("a1").items()])
    for c in "xy":
        low, high = [F.floor((F.col(f"e{c}") + d * NEAR * radius) / cell) for d in (-1, 1)]
        come = come.withColumn(f"_{c}", F.explode(F.array_distinct(F.array(low, high))))
    near = F.hypot(F.col("ex") - F.col("sx"), F.col("ey") - F.col("sy")) <= NEAR * radius
    back = F.col("a1") - F.col("s") - math.pi
    clockwise = back - TURN * F.floor(back / TURN)
    follow = come.join(leave, [*by, "_x", "_y"]).where(near).groupBy("arc").agg(F.min_by("next", F.struct(clockwise, "next")).alias("next"))
    tile = 64 * radius
    links = arcs.join(follow, "arc").select(F.col("arc").alias("id"), "next", F.lit(0).cast("long").alias("low"), F.floor(F.col("x") / tile).alias("tx"), F.floor(F.col("y") / tile).alias("ty"))
    ranked = rank_cycles(links, ["tx", "ty"]).select(F.col("id").alias("arc"), "ring", "place")
    return arcs.join(ranked, "arc")


def _part(x: Column, y: Column, radius: float) -> Column:
    """An arc's part of the area: half the integral of x dy - y dx."""
    a, b = F.col("a0"), F.col("a1")
    return (radius * radius * (b - a) + radius * x * (F.sin(b) - F.sin(a)) - radius * y * (F.cos(b) - F.cos(a))) / 2


def union_measures(arcs: DataFrame, radius: float, by: list[str]) -> DataFrame:
    """``(*by, area, perimeter)`` of each union, exact; coordinates are taken from its first disc, so no digits are lost."""
    origin = arcs.groupBy(*by).agg(F.min("x").alias("_ox"), F.min("y").alias("_oy"))
    part = _part(F.col("x") - F.col("_ox"), F.col("y") - F.col("_oy"), radius)
    return arcs.join(origin, by).groupBy(*by).agg(F.sum(part).alias("area"), F.sum((F.col("a1") - F.col("a0")) * radius).alias("perimeter"))


def disc_unions(points: DataFrame, radius: float, by: list[str], segments: int = 16) -> DataFrame:
    """``(*by, area, perimeter, rings)`` of the union of discs about the points of each ``by``.

    Area and perimeter are exact.  ``rings``: closed, outer ones first; an arc is drawn in ``segments`` chords a quarter
    turn at least, so rings lie within a disc's width of ``radius * (1 - cos(pi / 4 / segments))`` of the outline.
    """
    arcs = border_arcs(points, radius, by)
    placed = stage(_ring_places(arcs, radius, by), "arc-places")
    width = F.col("a1") - F.col("a0")
    chords = F.ceil(width / (math.pi / 2 / segments)).cast("int")
    at = lambda k: F.col("a0") + width * k / chords
    spot = lambda k: F.struct((F.col("x") + radius * F.cos(at(k))).alias("x"), (F.col("y") + radius * F.sin(at(k))).alias("y"))
    origin = placed.groupBy(*by).agg(F.min("x").alias("_ox"), F.min("y").alias("_oy"))
    part = _part(F.col("x") - F.col("_ox"), F.col("y") - F.col("_oy"), radius)
    drawn = placed.join(origin, by).select(*by, "ring", "place", part.alias("part"), F.transform(F.sequence(F.lit(0), chords - 1), spot).alias("spots"))
    ring = drawn.groupBy(*by, "ring").agg(F.sum("part").alias("size"), F.array_sort(F.collect_list(F.struct("place", "spots"))).alias("s"))
    ring = ring.withColumn("c", F.flatten("s.spots")).withColumn("c", F.concat("c", F.slice("c", 1, 1)))
    rings = ring.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("order"), "ring", "c"))).alias("r")).select(*by, F.col("r.c").alias("rings"))
    return union_measures(arcs, radius, by).join(rings, by)
