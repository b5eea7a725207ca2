"""Density zones, their metrics and outlines."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changegrid.config import Cleaning, ZoneShape, radius_pixels
from changegrid.operators.cells import near_pairs
from changegrid.operators.chains import rank_cycles
from changegrid.operators.neighborhood import close, disk_density
from changegrid.operators.ordering import number_rows
from changegrid.operators.pixels import drop_small, label_components
from changegrid.sources.staging import stage


def detect(candidates: DataFrame, height: int, width: int, cfg: Cleaning = Cleaning(), resolution_m: float = 10.0, tile: int = 256) -> DataFrame:
    """Radar detection of each period: candidate pixels, small components dropped, then closed."""
    mask = candidates.where("candidate").select("period_id", "r", "c")
    kept = drop_small(mask, cfg.least_pixels, ["period_id"], tile=tile)
    return close(kept, radius_pixels(cfg.closing_m, resolution_m), height, width, ["period_id"])


def density_zones(mask: DataFrame, height: int, width: int, cfg: ZoneShape = ZoneShape(), resolution_m: float = 10.0, tile: int = 256, keys: list[str] | None = None) -> DataFrame:
    """Small components dropped, dense disks kept, then closed (radius at least 1)."""
    keys = keys or []
    kept = drop_small(mask, cfg.cleaning.least_pixels, keys, tile=tile)
    dense = disk_density(kept, radius_pixels(cfg.window_m, resolution_m, 1), height, width, keys).where(F.col("density") >= cfg.dense_part)
    return close(dense.select(*keys, "r", "c"), radius_pixels(cfg.cleaning.closing_m, resolution_m, 1), height, width, keys)


def label_zones(mask: DataFrame, tile: int = 256, keys: list[str] | None = None) -> DataFrame:
    """Zones are 4-connected: corner contact does not join."""
    return label_components(mask, keys, eight=False, tile=tile)


def zone_metrics(labels: DataFrame, resolution_m: float = 10.0, keys: list[str] | None = None) -> DataFrame:
    """Area, perimeter (holes too) and compactness 4 pi A / max(P, 1)^2 of each zone, from its pixels."""
    zone = [*(keys or []), "comp_r", "comp_c"]
    # a pixel counts at its own place and as the neighbour of the places below and right of it: one exchange, no join
    seen = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((0, 0), (0, 1), (1, 0))]))
    own = (F.col("s.a") + F.col("s.b") == 0).cast("int")
    places = labels.select(*zone, "r", "c", seen.alias("s")).groupBy(*zone, F.col("r") + F.col("s.a"), F.col("c") + F.col("s.b")).agg(F.max(own).alias("own"), F.sum(1 - own).alias("near"))
    sizes = places.where("own = 1").groupBy(*zone).agg(F.count("*").alias("pixels"), F.sum("near").alias("shared"))
    perimeter = (4 * F.col("pixels") - 2 * F.col("shared")) * resolution_m
    out = sizes.select(*zone, "pixels", (F.col("pixels") * (resolution_m**2 / 10000)).alias("area_ha"), perimeter.alias("perim_m"))
    return out.withColumn("compactness", compactness(F.col("area_ha"), F.col("perim_m")))


def compactness(area_ha, perim_m):
    """4 pi A / max(P, 1)^2, as a Column."""
    return 4 * math.pi * area_ha * 10000 / F.pow(F.greatest(perim_m, F.lit(1.0)), F.lit(2.0))


def keep_zones(metrics: DataFrame, cfg: ZoneShape = ZoneShape(), keys: list[str] | None = None) -> DataFrame:
    """Zones that reach the least area and compactness, numbered by their first pixel.

    Numbers are consecutive within a raster; no task orders all zones.
    """
    kept = metrics.where((F.col("area_ha") >= cfg.least_ha) & (F.col("compactness") >= cfg.least_compactness))
    return number_rows(kept, ["comp_r", "comp_c"], keys, "zone_id")


def border_lines(labels: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``(*keys, comp_r, comp_c, ax, ay, bx, by)``: the straight lines of each zone's border, from corner to corner.

    Corner coordinates are column, then row; the zone lies to the right of a line.  Neighbours in a row or a
    column tell which sides of a pixel are border; equal sides that follow each other are one line.
    """
    zone = [*(keys or []), "comp_r", "comp_c"]
    row, column = Window.partitionBy(*zone, "r").orderBy("c"), Window.partitionBy(*zone, "c").orderBy("r")
    side = lambda at, move, there, window: F.coalesce(at(F.col(there)).over(window) != F.col(there) + move, F.lit(True))
    sides = labels.select(*zone, "r", "c", side(F.lag, -1, "r", column).alias("top"), side(F.lead, 1, "r", column).alias("bottom"), side(F.lag, -1, "c", row).alias("left"), side(F.lead, 1, "c", row).alias("right"))
    kinds = ("top", "bottom", "left", "right")
    held = F.explode(F.filter(F.array(*[F.when(F.col(k), F.lit(k)) for k in kinds]), lambda k: k.isNotNull())).alias("kind")
    flat = F.col("kind").isin("top", "bottom")
    each = sides.select(*zone, "r", "c", held).select(*zone, "kind", F.when(flat, F.col("r")).otherwise(F.col("c")).alias("line"), F.when(flat, F.col("c")).otherwise(F.col("r")).alias("at"))
    run = F.col("at") - F.row_number().over(Window.partitionBy(*zone, "kind", "line").orderBy("at"))
    lines = each.withColumn("run", run).groupBy(*zone, "kind", "line", "run").agg(F.min("at").alias("lo"), (F.max("at") + 1).alias("hi"))
    line = F.col("line") + F.when(F.col("kind").isin("bottom", "right"), 1).otherwise(0)
    onward = F.col("kind").isin("top", "right")
    start, end = F.when(onward, F.col("lo")).otherwise(F.col("hi")), F.when(onward, F.col("hi")).otherwise(F.col("lo"))
    ends = {f"{p}{axis}": (F.when(flat, at).otherwise(line) if axis == "x" else F.when(flat, line).otherwise(at)) for p, at in (("a", start), ("b", end)) for axis in "xy"}
    return lines.select(*zone, *[v.cast("int").alias(k) for k, v in ends.items()])


#: Corners of one task of the simplification, and side of the squares, in pixels, in which border lines are linked.
CHUNK, LINK_TILE = 1 << 15, 256


def ring_corners(labels: DataFrame, keys: list[str] | None = None, link_tile: int = LINK_TILE) -> DataFrame:
    """``(*keys, comp_r, comp_c, ring, place, n, cx, cy)``: the corners of each zone's rings, in order.

    Each border line is followed by the one that starts where it ends (of two, that which turns right, rows going
    down: corner contact does not join); rings are ranked across tiles, so no task holds a zone.
    """
    zone = [*(keys or []), "comp_r", "comp_c"]
    lines = stage(border_lines(labels, keys), "zone-lines")
    lines = stage(lines.withColumn("id", F.monotonically_increasing_id()), "zone-line-ids")
    onward = lines.select(*zone, F.col("ax").alias("bx"), F.col("ay").alias("by"), F.col("bx").alias("ex"), F.col("by").alias("ey"), F.col("id").alias("next"))
    turn = (F.col("bx") - F.col("ax")) * (F.col("ey") - F.col("by")) - (F.col("by") - F.col("ay")) * (F.col("ex") - F.col("bx"))
    links = lines.join(onward, [*zone, "bx", "by"]).groupBy("id").agg(F.max_by("next", turn).alias("next"), *[F.first(c).alias(c) for c in ("ax", "ay", *(keys or []))])
    low = F.col("ax").cast("long") * F.lit(1 << 31) + F.col("ay")
    tiles = [F.floor(F.col(c) / link_tile).alias(t) for c, t in (("ax", "tx"), ("ay", "ty"))]
    ranked = rank_cycles(links.select("id", "next", low.alias("low"), *(keys or []), *tiles), [*(keys or []), "tx", "ty"])
    return ranked.join(lines, "id").select(*zone, "ring", "place", "n", F.col("ax").alias("cx"), F.col("ay").alias("cy"))


def significance(x: np.ndarray, y: np.ndarray, fixed: list[int], least: float) -> np.ndarray:
    """For each corner the tolerance below which Douglas-Peucker keeps it, between the ``fixed`` ones, which it always does.

    The farthest corner of a stretch splits it at every tolerance below its distance, so a corner stays as long as its own
    distance and those of all splits above it exceed the tolerance.  Distances up to ``least`` are not told apart.
    """
    out = np.zeros(len(x))
    out[fixed] = np.inf
    todo = [(lo, hi, np.inf) for lo, hi in zip(fixed, fixed[1:], strict=False)]
    while todo:
        lo, hi, above = todo.pop()
        if hi - lo < 2:
            continue
        dx, dy = x[hi] - x[lo], y[hi] - y[lo]
        span = np.hypot(dx, dy)
        px, py = x[lo + 1 : hi], y[lo + 1 : hi]
        d = np.abs(dx * (y[lo] - py) - (x[lo] - px) * dy) / span if span else np.hypot(px - x[lo], py - y[lo])
        at = int(d.argmax())
        above = min(above, float(d[at]))
        if above > least:
            at += lo + 1
            out[at] = above
            todo += [(lo, at, above), (at, hi, above)]
    return out


def _edges_at(corners: DataFrame, zone: list[str], tolerance: Column) -> DataFrame:
    """The edges between the corners kept at ``tolerance``: they begin at ``place`` and end at ``to``."""
    kept = corners.where((F.col("sig") > tolerance) | (F.col("floor") <= tolerance))
    order = Window.partitionBy(*zone, "ring", "chunk").orderBy("step")
    ends = {f"b{a}": F.lead(f"a{a}").over(order) for a in "xy"} | {"to": F.lead("place").over(order)}
    return kept.withColumns(ends).where("to IS NOT NULL").drop("sig", "floor", "step", "chunk")


def crossed_zones(edges: DataFrame, zone: list[str], cell: float) -> DataFrame:
    """Zones with two edges that meet anywhere but at the end of one and the start of the next, or corner on corner."""
    box = {f"{a}{n}": f(f"a{a}", f"b{a}") for a in "xy" for n, f in ((0, F.least), (1, F.greatest))}
    met = near_pairs(edges.withColumns(box), edges.withColumns(box), cell, zone)
    met = met.where(F.struct("pring", "pplace") < F.struct("qring", "qplace"))
    c = {k: (F.col(f"{k[0]}{k[1]}x"), F.col(f"{k[0]}{k[1]}y")) for k in ("pa", "pb", "qa", "qb")}

    def turn(p: str, q: str, r: str) -> Column:
        (px, py), (qx, qy), (rx, ry) = c[p], c[q], c[r]
        return F.signum((qx - px) * (ry - py) - (qy - py) * (rx - px))

    def on(p: str, q: str, r: str) -> Column:
        """r lies on the line from p to q, but at neither end."""
        same = lambda u, v: (c[u][0] == c[v][0]) & (c[u][1] == c[v][1])
        within = [r_.between(F.least(p_, q_), F.greatest(p_, q_)) for p_, q_, r_ in zip(c[p], c[q], c[r], strict=True)]
        return (turn(p, q, r) == 0) & within[0] & within[1] & ~same(p, r) & ~same(q, r)

    follow = (F.col("pring") == F.col("qring")) & ((F.col("pto") == F.col("qplace")) | (F.col("qto") == F.col("pplace")))
    back = (c["pa"][0] == c["qb"][0]) & (c["pa"][1] == c["qb"][1]) & (c["pb"][0] == c["qa"][0]) & (c["pb"][1] == c["qa"][1])
    through = (turn("pa", "pb", "qa") * turn("pa", "pb", "qb") < 0) & (turn("qa", "qb", "pa") * turn("qa", "qb", "pb") < 0)
    touch = on("pa", "pb", "qa") | on("pa", "pb", "qb") | on("qa", "qb", "pa") | on("qa", "qb", "pb")
    return met.where(F.when(follow, back).otherwise(through | touch)).select(*zone).distinct()


def _number(x: Column) -> Column:
    """A coordinate as text, to the sixth decimal, without trailing zeros."""
    return F.regexp_replace(x.cast("decimal(30,6)").cast("string"), r"\.?0+$", "")


def zone_outlines(
    labels: DataFrame, resolution_m: float = 10.0, x0: float = 0.0, y0: float = 0.0, tolerance_m: float = ZoneShape.tolerance_m, keys: list[str] | None = None, chunk: int = CHUNK, link_tile: int = LINK_TILE
) -> DataFrame:
    """``(*keys, comp_r, comp_c, rings, wkt, n_vertices, simplified_area_ha, simplified_perim_m)`` of each zone.

    Spark finds the border, joins it to straight lines and links these to rings across tiles.  Rings are simplified within
    ``tolerance_m``, those of more than ``chunk`` corners between fixed corners that far apart.  Where edges of a zone would
    meet, found by a join on cells, its tolerance is halved, down to none, so the topology stays.  Every corner carries the
    tolerance below which it is kept, so other tolerances are filters.  Rows go down from y0; outer rings come first.
    """
    zone = [*(keys or []), "comp_r", "comp_c"]
    least = tolerance_m / 32
    corners = ring_corners(labels, keys, link_tile)
    # pieces of nearly equal size, three at least where a ring is cut; each also gets the first corner of the next
    pieces = F.when(F.col("n") <= chunk, 1).otherwise(F.greatest(F.lit(3), F.ceil(F.col("n") / chunk)))
    piece = lambda at: F.floor(at * F.col("pieces") / F.col("n"))
    own = corners.withColumn("pieces", pieces.cast("long")).withColumn("chunk", piece(F.col("place")))
    before = F.pmod(F.col("chunk") - 1, F.col("pieces"))
    starts = (F.col("place") == 0) | (piece(F.col("place") - 1) < F.col("chunk"))
    both = F.array(F.struct("chunk", F.col("place").alias("step")), F.struct(before.alias("chunk"), F.when(F.col("place") == 0, F.col("n")).otherwise(F.col("place")).alias("step")))
    each = own.withColumn("e", F.explode(F.when(starts, both).otherwise(F.slice(both, 1, 1)))).drop("chunk").select("*", "e.*").drop("e")

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("step", kind="stable").reset_index(drop=True)
        x, y, last = (x0 + pdf.cx * resolution_m).to_numpy(), (y0 - pdf.cy * resolution_m).to_numpy(), len(pdf) - 1
        fixed, whole = [0, last], pdf.pieces[0] == 1
        if whole:  # a whole ring: also from the corner farthest from the first
            fixed = [0, 1 + int(np.hypot(x[1:-1] - x[0], y[1:-1] - y[0]).argmax()), last]
        sig = significance(x, y, fixed, least)
        # at tolerances from here on fewer than three corners would be left: the ring stays as it is
        floor = float(np.sort(sig[:-1])[-3]) if whole else np.inf
        return pdf.assign(ax=x, ay=y, sig=sig, floor=floor)[[*zone, "ring", "chunk", "step", "place", "ax", "ay", "sig", "floor"]]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in labels.select(*zone).schema.fields)
    schema += ", ring long, chunk long, step long, place long, ax double, ay double, sig double, floor double"
    judged = stage(each.groupBy(*zone, "ring", "chunk").applyInPandas(judge, schema), "zone-corners")
    cell, tolerance, done = 64 * resolution_m, tolerance_m, None
    left = judged
    while tolerance > 0:
        edges = stage(_edges_at(left, zone, F.lit(tolerance)), "zone-edges")
        crossed = stage(crossed_zones(edges, zone, cell), "zone-crossed")
        none = crossed.isEmpty()
        good = edges if none else edges.join(crossed, zone, "left_anti")
        done = good if done is None else done.unionByName(good)
        if none:
            break
        left, tolerance = left.join(crossed, zone, "left_semi"), tolerance / 2 if tolerance > tolerance_m / 16 else 0
    else:  # as traced
        traced = _edges_at(left, zone, F.lit(-1.0))
        done = traced if done is None else done.unionByName(traced)
    corner = F.struct("place", F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")).alias("at"))
    # seen from the ring's first corner, so large coordinates cost no digits
    firsts = done.where("place = 0").select(*zone, "ring", F.col("ax").alias("ox"), F.col("ay").alias("oy"))
    seen = done.join(firsts, [*zone, "ring"]).withColumn("part", ((F.col("ax") - F.col("ox")) * (F.col("by") - F.col("oy")) - (F.col("bx") - F.col("ox")) * (F.col("ay") - F.col("oy"))) / 2)
    ring = seen.groupBy(*zone, "ring").agg(F.sum("part").alias("signed"), F.sum(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))).alias("length"), F.array_sort(F.collect_list(corner)).alias("c"))
    closed = ring.withColumn("c", F.concat(F.col("c.at"), F.slice("c.at", 1, 1)))
    held = closed.groupBy(*zone).agg(F.array_sort(F.collect_list(F.struct((-F.abs("signed")).alias("size"), "ring", "c"))).alias("r"), F.abs(F.sum("signed")).alias("area"), F.sum("length").alias("length"), F.sum(F.size("c")).cast("long").alias("n_vertices"))
    text = F.transform("r.c", lambda c: F.concat(F.lit("("), F.array_join(F.transform(c, lambda p: F.concat_ws(" ", _number(p["x"]), _number(p["y"]))), ", "), F.lit(")")))
    wkt = F.concat(F.lit("POLYGON ("), F.array_join(text, ", "), F.lit(")"))
    return held.select(*zone, F.col("r.c").alias("rings"), wkt.alias("wkt"), "n_vertices", (F.col("area") / 10000).alias("simplified_area_ha"), F.col("length").alias("simplified_perim_m"))


def zone_polygons(labels: DataFrame, cfg: ZoneShape = ZoneShape(), resolution_m: float = 10.0, x0: float = 0.0, y0: float = 0.0, keys: list[str] | None = None) -> DataFrame:
    """Zones as simplified polygons, measured after simplification, then filtered and numbered."""
    shapes = zone_outlines(labels, resolution_m, x0, y0, cfg.tolerance_m, keys).withColumnsRenamed({"simplified_area_ha": "area_ha", "simplified_perim_m": "perim_m"})
    return keep_zones(shapes.withColumn("compactness", compactness(F.col("area_ha"), F.col("perim_m"))), cfg, keys)
