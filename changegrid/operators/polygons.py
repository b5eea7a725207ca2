"""Polygons of any shape: points in them, polygons that meet, their union and the areas they share.

A polygon is ``rings``: closed, the outer ring first, then holes; a shape of several parts holds all its rings.  A place is
inside where an odd number of edges lies below it; borders belong to the polygon.  Edges, not polygons, are the unit of
work: they meet in cells of their own size or in slabs of x, so a polygon of many edges is many rows and no task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changegrid.operators.cells import near_pairs
from changegrid.operators.chains import rank_cycles
from changegrid.sources.staging import stage

#: A polygon of more edges than FEW is covered by cells of a SIDE-th of its size; slabs hold about PER_SLAB edges, SLABS at most.
FEW, SIDE, PER_SLAB, SLABS = 64, 16, 8, 4096
TURN = 2 * math.pi


def _signed(ring: Column) -> Column:
    nxt = F.slice(ring, F.lit(2), F.size(ring))
    x, y = ring[0]["x"], ring[0]["y"]
    cross = F.zip_with(ring, nxt, lambda a, b: F.when(b.isNotNull(), (a["x"] - x) * (b["y"] - y) - (b["x"] - x) * (a["y"] - y)).otherwise(0.0))
    return F.aggregate(cross, F.lit(0.0), lambda acc, v: acc + v) / 2


def edges_of(polygons: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, ax, ay, bx, by)``: the edges, directed so that the inside lies to their left; those without length are left out."""
    each = polygons.select(*keys, F.posexplode("rings").alias("i", "ring"))
    turned = F.when((_signed(F.col("ring")) < 0) == (F.col("i") == 0), F.reverse("ring")).otherwise(F.col("ring"))
    each = each.select(*keys, turned.alias("ring"))
    pair = F.arrays_zip(F.slice("ring", F.lit(1), F.size("ring") - 1).alias("a"), F.slice("ring", F.lit(2), F.size("ring") - 1).alias("b"))
    cut = each.where(F.size("ring") > 1).select(*keys, F.explode(pair).alias("e"))
    out = cut.select(*keys, *[F.col(f"e.{p}.{c}").alias(f"{p}{c}") for p in "ab" for c in "xy"])
    return out.where("ax != bx OR ay != by")


def boxed(edges: DataFrame) -> DataFrame:
    return edges.withColumns({f"{c}{n}": f(f"a{c}", f"b{c}") for c in "xy" for n, f in ((0, F.least), (1, F.greatest))})


def _slab(x: Column, k: str = "_slabs") -> Column:
    """The slab of x among ``k`` of them between ``_sx0`` and ``_sx1``."""
    at = F.floor((x - F.col("_sx0")) / (F.col("_sx1") - F.col("_sx0")) * F.col(k))
    return F.coalesce(F.least(F.greatest(at, F.lit(0)), F.col(k) - 1), F.lit(0)).cast("int")


def _slabs(n: Column) -> Column:
    return F.least(F.greatest(F.ceil(n / PER_SLAB), F.lit(1)), F.lit(SLABS)).cast("int")


def _ring_test(pairs: DataFrame, edges: DataFrame, shapes: DataFrame, keys: list[str]) -> DataFrame:
    """Of ``(*keys, x, y)``, different rows, those inside the polygon or on its border (``border``).

    A place meets the edges of its slab only; ``shapes`` has each polygon's range of x (``_sx0``, ``_sx1``) and slabs (``_slabs``).
    """
    own = pairs.join(shapes.select(*keys, "_sx0", "_sx1", "_slabs"), keys).withColumn("_slab", _slab(F.col("x"))).select(*keys, "x", "y", "_slab")
    dealt = edges.join(shapes.select(*keys, "_sx0", "_sx1", "_slabs"), keys)
    dealt = dealt.withColumn("_slab", F.explode(F.sequence(_slab(F.least("ax", "bx")), _slab(F.greatest("ax", "bx"))))).drop("_sx0", "_sx1", "_slabs")
    cross = (F.col("bx") - F.col("ax")) * (F.col("y") - F.col("ay")) - (F.col("x") - F.col("ax")) * (F.col("by") - F.col("ay"))
    over = (F.col("ax") > F.col("x")) != (F.col("bx") > F.col("x"))
    above = over & F.when(F.col("bx") > F.col("ax"), cross > 0).otherwise(cross < 0)
    on = (cross == 0) & F.col("x").between(F.least("ax", "bx"), F.greatest("ax", "bx")) & F.col("y").between(F.least("ay", "by"), F.greatest("ay", "by"))
    met = own.join(dealt, [*keys, "_slab"]).groupBy(*keys, "x", "y").agg(F.sum(above.cast("int")).alias("below"), F.bool_or(on).alias("border"))
    return met.where("border OR below % 2 = 1").select(*keys, "x", "y", "border")


def spots_in_polygons(spots: DataFrame, polygons: DataFrame, keys: list[str], cell: float = 500.0) -> DataFrame:
    """``(*keys, x, y, border)``: the different places ``(x, y)`` of ``spots`` by the polygons that hold them.

    A polygon is covered by cells of a part of its size, a number that does not grow with it: places in cells without an
    edge need no test, those in cells at the border meet the edges of their slab.
    """
    edges = stage(boxed(edges_of(polygons, keys)), "polygon-edges")
    held = edges.groupBy(*keys).agg(F.count("*").alias("n"), F.min("x0").alias("_sx0"), F.max("x1").alias("_sx1"), F.min("y0").alias("_sy0"), F.max("y1").alias("_sy1"))
    side = F.greatest(F.col("_sx1") - F.col("_sx0"), F.col("_sy1") - F.col("_sy0")) / F.when(F.col("n") > FEW, F.lit(SIDE)).otherwise(F.lit(1))
    level = F.greatest(F.lit(0), F.least(F.lit(60), F.ceil(F.log2(side / cell)))).cast("int")
    shapes = stage(held.withColumns({"_slabs": _slabs(F.col("n")), "level": level}), "polygon-shapes")
    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("level"))
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / size), F.floor(F.col(hi) / size)))
    every = shapes.select(*keys, "level", cells("_sx0", "_sx1").alias("cx"), "_sy0", "_sy1").withColumn("cy", cells("_sy0", "_sy1")).drop("_sy0", "_sy1")
    border = edges.join(shapes.select(*keys, "level"), keys).withColumn("cx", cells("x0", "x1")).withColumn("cy", cells("y0", "y1")).select(*keys, "level", "cx", "cy").distinct()
    border = stage(border, "polygon-border")
    inner = every.join(border, [*keys, "level", "cx", "cy"], "left_anti").select("*", ((F.col("cx") + 0.5) * size).alias("x"), ((F.col("cy") + 0.5) * size).alias("y"))
    inner = inner.join(_ring_test(inner.select(*keys, "x", "y"), edges, shapes, keys), [*keys, "x", "y"], "left_semi").select(*keys, "level", "cx", "cy", F.lit(False).alias("near"))
    cover = stage(inner.unionByName(border.withColumn("near", F.lit(True))), "polygon-cover")
    levels = sorted(r[0] for r in shapes.select("level").distinct().collect()) or [0]  # 61 numbers at most
    at = [F.struct(F.lit(n).alias("level"), F.floor(F.col("x") / (cell * 2.0**n)).alias("cx"), F.floor(F.col("y") / (cell * 2.0**n)).alias("cy")) for n in levels]
    sent = spots.where("x IS NOT NULL AND y IS NOT NULL").select("x", "y").distinct().withColumn("p", F.explode(F.array(*at))).select("x", "y", "p.*")
    met = stage(sent.join(cover, ["level", "cx", "cy"]).select(*keys, "x", "y", "near"), "polygon-met")
    tested = _ring_test(met.where("near").select(*keys, "x", "y"), edges, shapes, keys)
    return met.where("NOT near").select(*keys, "x", "y", F.lit(False).alias("border")).unionByName(tested)


def points_in_polygons(points: DataFrame, polygons: DataFrame, keys: list[str], cell: float = 500.0) -> DataFrame:
    """Points by the polygons that hold them, borders too: the points' columns and the polygons' ``keys``."""
    return points.join(spots_in_polygons(points, polygons, keys, cell).select(*keys, "x", "y"), ["x", "y"])


def _crossings(met: DataFrame) -> DataFrame:
    """Of pairs of edges (p, q), those with a place in common, as ``at``: one place, or two where they run along each other."""
    px, py, qx, qy = ({e: F.col(f"{s}{e}{c}") for e in "ab"} for s, c in (("p", "x"), ("p", "y"), ("q", "x"), ("q", "y")))
    turn = lambda ox, oy, tx, ty, rx, ry: (tx - ox) * (ry - oy) - (ty - oy) * (rx - ox)
    qa, qb = (turn(px["a"], py["a"], px["b"], py["b"], qx[e], qy[e]) for e in "ab")
    pa, pb = (turn(qx["a"], qy["a"], qx["b"], qy["b"], px[e], py[e]) for e in "ab")
    spot = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    within = lambda v, u, w: v.between(F.least(u, w), F.greatest(u, w))
    ends = []
    for s, (x, y), (ox, oy), t in (("p", (px, py), (qx, qy), (pa, pb)), ("q", (qx, qy), (px, py), (qa, qb))):
        for e, zero in zip("ab", t, strict=True):
            on = (zero == 0) & within(x[e], ox["a"], ox["b"]) & within(y[e], oy["a"], oy["b"])
            ends.append(F.when(on, spot(x[e], y[e])))
    share = pa / (pa - pb)
    through = (F.signum(qa) * F.signum(qb) < 0) & (F.signum(pa) * F.signum(pb) < 0)
    # an edge along an axis gives its own coordinate, so all that cross it do so in line
    exact = lambda p, q: F.when(p["a"] == p["b"], p["a"]).when(q["a"] == q["b"], q["a"]).otherwise(p["a"] + share * (p["b"] - p["a"]))
    cross = F.when(through, spot(exact(px, qx), exact(py, qy)))
    at = F.filter(F.array_distinct(F.array(cross, *ends)), lambda s: s.isNotNull())
    return met.withColumn("at", at).where(F.size("at") > 0)


def polygons_meet(left: DataFrame, right: DataFrame, key: str, other: str, cell: float = 500.0) -> DataFrame:
    """``(key, other)``: pairs of a polygon of ``left`` and one of ``right`` that share a place, borders too, once each.

    Two polygons meet if edges of theirs do, else if one holds a corner of the other.
    """
    a, b = (stage(boxed(edges_of(df, [k])), "meet-edges") for df, k in ((left, key), (right, other)))
    touch = _crossings(near_pairs(a.withColumnRenamed(key, "shape"), b.withColumnRenamed(other, "shape"), cell)).select(F.col("pshape").alias(key), F.col("qshape").alias(other))
    first = lambda df, k: df.select(k, *[F.col("rings")[0][0][c].alias(c) for c in "xy"]).where("x IS NOT NULL AND y IS NOT NULL")
    in_right = points_in_polygons(first(left, key), right, [other], cell).select(key, other)
    in_left = points_in_polygons(first(right, other), left, [key], cell).select(key, other)
    return touch.unionByName(in_right).unionByName(in_left).distinct()


def dissolve(polygons: DataFrame, cell: float = 500.0) -> DataFrame:
    """One row ``(rings, area)``: the union of all polygons, the largest part first; overlaps and holes are resolved.

    Edges are split where they meet others; a piece inside another polygon goes, and so do both of two pieces that run
    against each other (the inside lies on either side); of equal pieces one stays, and of equal polygons.  What is left is linked to rings with the
    inside to their left, parts that touch in a corner apart.  An empty table gives an empty result.
    """
    named = stage(polygons.select("rings").distinct(), "dissolve-shapes")
    named = stage(named.withColumn("poly", F.monotonically_increasing_id()), "dissolve-named")
    edges = stage(boxed(edges_of(named, ["poly"])), "dissolve-edges")
    edges = stage(edges.withColumn("e", F.monotonically_increasing_id()), "dissolve-edge-ids")
    met = _crossings(near_pairs(edges, edges, cell).where("pe < qe"))
    spots = stage(met.select("pe", "qe", F.explode("at").alias("at")), "dissolve-crossings")
    cuts = spots.select(F.col("pe").alias("e"), "at").unionByName(spots.select(F.col("qe").alias("e"), "at"))
    ends = edges.select("e", F.explode(F.array(*[F.struct(F.col(f"{p}x").alias("x"), F.col(f"{p}y").alias("y")) for p in "ab"])).alias("at"))
    every = cuts.unionByName(ends).distinct().join(edges.select("e", "poly", "ax", "ay", "bx", "by"), "e")
    along = (F.col("at.x") - F.col("ax")) * (F.col("bx") - F.col("ax")) + (F.col("at.y") - F.col("ay")) * (F.col("by") - F.col("ay"))
    order = Window.partitionBy("e").orderBy("along", "at")
    pieces = every.withColumn("along", along).withColumn("to", F.lead("at").over(order)).where("to IS NOT NULL")
    pieces = pieces.select("poly", F.col("at").alias("a"), F.col("to").alias("b"))
    # equal pieces once; pieces against each other not at all
    ways = pieces.groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(F.bool_or(F.col("a") < F.col("b")).alias("up"), F.bool_or(F.col("a") > F.col("b")).alias("down"), F.collect_set("poly").alias("own"))
    ways = stage(ways.where("up != down").select("lo", "hi", "up", "own", ((F.col("lo.x") + F.col("hi.x")) / 2).alias("x"), ((F.col("lo.y") + F.col("hi.y")) / 2).alias("y")), "dissolve-pieces")
    inside = spots_in_polygons(ways, named, ["poly"], cell).where("NOT border").select("x", "y", "poly")
    covered = ways.join(inside, ["x", "y"]).where(~F.array_contains("own", F.col("poly"))).select("lo", "hi").distinct()
    left = stage(ways.join(covered, ["lo", "hi"], "left_anti"), "dissolve-left")
    left = stage(left.select(F.monotonically_increasing_id().alias("id"), F.when(F.col("up"), F.col("lo")).otherwise(F.col("hi")).alias("a"), F.when(F.col("up"), F.col("hi")).otherwise(F.col("lo")).alias("b")), "dissolve-directed")
    then = left.select(F.col("id").alias("next"), F.col("a").alias("b"), F.col("b").alias("c"))
    heading = lambda p, q: F.atan2(F.col(f"{q}.y") - F.col(f"{p}.y"), F.col(f"{q}.x") - F.col(f"{p}.x"))
    back = heading("b", "a") - heading("b", "c")
    clockwise = back - TURN * F.floor(back / TURN)
    follow = left.join(then, "b").groupBy("id").agg(F.min_by("next", F.struct(F.when(clockwise == 0, TURN).otherwise(clockwise), "next")).alias("next"))
    tile = 64 * cell
    links = left.join(follow, "id").select("id", "next", F.lit(0).cast("long").alias("low"), F.floor(F.col("a.x") / tile).alias("tx"), F.floor(F.col("a.y") / tile).alias("ty"))
    placed = rank_cycles(links, ["tx", "ty"]).join(left, "id")
    ring = placed.groupBy("ring").agg(F.array_sort(F.collect_list(F.struct("place", "a"))).alias("c")).withColumn("c", F.concat("c.a", F.slice("c.a", 1, 1)))
    ring = ring.withColumn("size", _signed(F.col("c")))
    return ring.agg(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("order"), "ring", "c"))).alias("r"), F.sum("size").alias("area")).where("area IS NOT NULL").select(F.col("r.c").alias("rings"), "area")


def shared_areas(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, shared)``: the area common to the polygons ``prings`` and ``qrings`` of each pair, 0 if there is none.

    The strips below two edges share the lower of two lines wherever both run; signed by their directions, the shares of
    all pairs of edges add up.  Edges are dealt to slabs of the x that both polygons span, so an edge meets the
    few of its slab and the work is near the sum of the edges, not their product.
    """
    held = stage(pairs.select(*keys, "prings", "qrings"), "shared-pairs")
    spot = F.struct(F.col("prings")[0][0]["x"].alias("ox"), F.col("prings")[0][0]["y"].alias("oy"))
    xs = lambda f, c: f(F.flatten(c)["x"])
    count = F.size(F.flatten("prings")) + F.size(F.flatten("qrings"))
    span = held.select(*keys, spot.alias("o"), F.greatest(xs(F.array_min, "prings"), xs(F.array_min, "qrings")).alias("_sx0"), F.least(xs(F.array_max, "prings"), xs(F.array_max, "qrings")).alias("_sx1"), _slabs(count).alias("_slabs"))
    span = stage(span.select(*keys, "o.*", "_sx0", "_sx1", "_slabs").where("_sx1 > _sx0"), "shared-spans")

    def dealt(side: str) -> DataFrame:
        cut = edges_of(held.select(*keys, F.col(side).alias("rings")), keys).where("ax != bx").join(span, keys)
        cut = cut.where((F.greatest("ax", "bx") > F.col("_sx0")) & (F.least("ax", "bx") < F.col("_sx1")))
        cut = cut.withColumn("_slab", F.explode(F.sequence(_slab(F.least("ax", "bx")), _slab(F.greatest("ax", "bx")))))
        # an edge from right to left has the inside below it
        back = F.col("bx") < F.col("ax")
        at = {f"{p}{c}": F.when(back, F.col(f"{u}{c}")).otherwise(F.col(f"{v}{c}")) - F.col(f"o{c}") for p, u, v in (("l", "b", "a"), ("r", "a", "b")) for c in "xy"}
        edge = [F.col("_sx0") + (F.col("_sx1") - F.col("_sx0")) * (F.col("_slab") + n) / F.col("_slabs") for n in (0, 1)]
        return cut.select(*keys, "_slab", (edge[0] - F.col("ox")).alias("w0"), (edge[1] - F.col("ox")).alias("w1"), F.when(back, 1.0).otherwise(-1.0).alias("s"), *[v.alias(k) for k, v in at.items()])

    p, q = dealt("prings"), dealt("qrings")
    q = q.select(*keys, "_slab", *[F.col(c).alias(f"q{c}") for c in ("s", "lx", "ly", "rx", "ry")])
    met = p.join(q, [*keys, "_slab"])
    lo, hi = F.greatest("w0", "lx", "qlx"), F.least("w1", "rx", "qrx")
    line = lambda n, x: F.col(f"{n}ly") + (F.col(f"{n}ry") - F.col(f"{n}ly")) * ((x - F.col(f"{n}lx")) / (F.col(f"{n}rx") - F.col(f"{n}lx")))
    a, b = line("", lo) - line("q", lo), line("", hi) - line("q", hi)
    apart = F.when(a * b < 0, (a * a + b * b) / (F.abs(a) + F.abs(b))).otherwise(F.abs(a + b))
    lower = (line("", lo) + line("", hi) + line("q", lo) + line("q", hi) - apart) / 4
    part = F.when(hi > lo, F.col("s") * F.col("qs") * (hi - lo) * lower).otherwise(0.0)
    found = met.groupBy(*keys).agg(F.sum(part).alias("shared"))
    return held.select(*keys).join(found, keys, "left").withColumn("shared", F.coalesce("shared", F.lit(0.0)))
