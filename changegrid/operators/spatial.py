"""Spatial joins through cell hashing, polygon measures, point clusters, evidence and evaluation.

Rings are ``array<struct<x, y>>``, closed.  Joins are equi-joins on grid cells followed by an exact test,
so only rows of near cells meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changegrid.config import Fusion
from changegrid.operators.cells import cells_of, level_of, levels_of, near_pairs
from changegrid.operators.components import connected_components
from changegrid.operators.polygons import shared_areas, spots_in_polygons
from changegrid.sources.staging import stage


def points_in_rects(points: DataFrame, rects: DataFrame, cell: float = 500.0, parts: int = 1) -> DataFrame:
    """Points by the rectangles ``(x0, y0, x1, y1)`` that hold them, borders too.

    A rectangle is dealt to cells of its own size (``cell``, doubled), so a large one costs four rows, or of one of ``parts``
    of it; a point is sent to its cell at each size that occurs.  Missing coordinates hold nothing.
    """
    size = F.lit(cell / parts) * F.pow(F.lit(2.0), F.col("_rl"))
    dealt = rects.withColumn("_rl", level_of(cell))
    dealt = dealt.withColumn("_rx", F.explode(cells_of(F.col("x0"), F.col("x1"), size))).withColumn("_ry", F.explode(cells_of(F.col("y0"), F.col("y1"), size)))
    at = [F.struct(F.lit(n).alias("l"), F.floor(F.col("x") / (cell / parts * 2.0**n)).alias("x"), F.floor(F.col("y") / (cell / parts * 2.0**n)).alias("y")) for n in levels_of(rects, cell) or [0]]
    own = points.withColumn("_p", F.explode(F.array(*at)))
    inside = F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))
    same = [F.col("_p.l") == F.col("_rl"), F.col("_p.x") == F.col("_rx"), F.col("_p.y") == F.col("_ry")]
    return own.join(dealt, [*same, inside]).drop("_p", "_rl", "_rx", "_ry")


def ring_area(ring: Column) -> Column:
    """Area inside a closed ring (shoelace)."""
    nxt = F.slice(ring, F.lit(2), F.size(ring))
    cross = F.zip_with(ring, nxt, lambda a, b: F.when(b.isNotNull(), a["x"] * b["y"] - b["x"] * a["y"]).otherwise(0.0))
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda acc, x: acc + x)) / 2


def ring_length(ring: Column) -> Column:
    nxt = F.slice(ring, F.lit(2), F.size(ring))
    step = F.zip_with(ring, nxt, lambda a, b: F.when(b.isNotNull(), F.hypot(b["x"] - a["x"], b["y"] - a["y"])).otherwise(0.0))
    return F.aggregate(step, F.lit(0.0), lambda acc, x: acc + x)


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies inside a closed ring or on it."""
    nxt = F.slice(ring, F.lit(2), F.size(ring))

    def edge(a, b):
        cross = (b["x"] - a["x"]) * (y - a["y"]) - (x - a["x"]) * (b["y"] - a["y"])
        on = (cross == 0) & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))
        over = (a["y"] > y) != (b["y"] > y)
        left = F.when(b["y"] > a["y"], cross > 0).otherwise(cross < 0)
        return F.when(b.isNull(), 0).when(on, 1000000).when(over & left, 1).otherwise(0)

    hits = F.aggregate(F.zip_with(ring, nxt, edge), F.lit(0), lambda acc, v: acc + v)
    return (hits >= 1000000) | (hits % 2 == 1)


#: Corners, the closing one included, up to which a convex ring is tested by plain arithmetic, which Spark compiles.
CORNERS = 9


def _convex(ring: Column) -> Column:
    """Whether a ring is closed, has no corner twice and at most ``CORNERS``, and lies to the left of each of its edges."""
    nxt = F.slice(ring, F.lit(2), F.size(ring))
    left = lambda a, b: F.forall(ring, lambda c: (b["x"] - a["x"]) * (c["y"] - a["y"]) - (c["x"] - a["x"]) * (b["y"] - a["y"]) >= 0)
    bent = F.forall(F.zip_with(ring, nxt, lambda a, b: b.isNull() | left(a, b)), lambda v: v)
    return F.coalesce(F.size(ring).between(4, CORNERS) & (ring[0] == F.element_at(ring, -1)) & (F.size(F.array_distinct(ring)) == F.size(ring) - 1) & bent, F.lit(False))


def points_in_rings(points: DataFrame, polygons: DataFrame, cell: float = 500.0) -> DataFrame:
    """Points by the polygons (column ``ring``) that hold them, borders too.

    Polygons of equal rings are one shape, tested once and then joined to all polygons of that shape.  A convex ring of few
    corners holds what lies to the left of each edge.
    """
    box = {"x0": F.array_min("ring.x"), "x1": F.array_max("ring.x"), "y0": F.array_min("ring.y"), "y1": F.array_max("ring.y")}
    shapes = stage(polygons.select("ring").distinct(), "ring-shapes").withColumns({"_turned": F.reverse("ring"), **box})
    turned = F.when(F.size("ring") > CORNERS, None).when(_convex(F.col("ring")), F.col("ring")).when(_convex(F.col("_turned")), F.col("_turned"))
    shapes = stage(shapes.select("ring", *box, turned.alias("_turned"), F.monotonically_increasing_id().alias("_shape")), "ring-boxes")
    members = stage(polygons.join(shapes.select("ring", "_shape"), "ring"), "ring-members")
    most = shapes.agg(F.max(F.size("_turned"))).first()[0] or 1
    # the last corner stands for those that a shorter ring lacks: an edge without length excludes nothing
    corner = lambda i: F.get("_turned", F.least(F.lit(i), F.size("_turned") - 1))
    few = stage(shapes.where("_turned IS NOT NULL").select("_shape", *box, *[corner(i)[c].alias(f"_{c}{i}") for i in range(most) for c in "xy"]), "ring-corners")
    inside = F.lit(True)
    for i in range(most - 1):
        ax, ay, bx, by = (F.col(f"_{c}{i + k}") for k in (0, 1) for c in "xy")
        inside = inside & ((bx - ax) * (F.col("y") - ay) - (F.col("x") - ax) * (by - ay) >= 0)
    hits = points_in_rects(points, few, cell, 2).where(inside).select(*points.columns, "_shape")
    many = shapes.where("_turned IS NULL").drop("_turned")
    if not many.isEmpty():
        hits = hits.unionByName(points_in_rects(points, many, cell).where(in_ring(F.col("x"), F.col("y"), F.col("ring"))).select(*points.columns, "_shape"))
    return hits.join(members, "_shape").select(*points.columns, *polygons.columns)


def rect_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))


def _hits(points: DataFrame, shapes: DataFrame, more: list[str]) -> DataFrame:
    """``(x, y, *more)``: places by the shapes that hold them, one row a hit; shapes are polygons (``rings``) or rectangles."""
    if "rings" not in shapes.columns:
        return points_in_rects(points.select("x", "y").distinct(), shapes.select("x0", "y0", "x1", "y1", *more)).select("x", "y", *more)
    # rows of one shape are told apart by a number, which must not change once it is given
    held = stage(stage(shapes.select("rings", *more), "hit-shapes").withColumn("_shape", F.monotonically_increasing_id()), "hit-shape-ids")
    found = spots_in_polygons(points, held, ["_shape"])
    return found.join(held.drop("rings"), "_shape").select("x", "y", *more)


def evidence_flags(points: DataFrame, shapes: DataFrame, key: str = "point_id") -> DataFrame:
    """Adds a flag for each kind of evidence in ``shapes`` (column ``kind``): one row a point, however many hits.

    ``shapes``: polygons of any shape (``rings``: outer first, then holes) or rectangles (``x0, y0, x1, y1``); borders count.
    """
    kinds = ("amplitude_support", "optical_support", "optical_reliable", "context_support")
    spots = _hits(points, shapes, ["kind"]).groupBy("x", "y").agg(*[F.bool_or(F.col("kind") == k).alias(k) for k in kinds])
    hit = points.select(key, "x", "y").join(spots, ["x", "y"]).drop("x", "y")
    out = points.join(hit, key, "left")
    return out.withColumns({k: F.coalesce(k, F.lit(False)) for k in kinds})


def confidence(points: DataFrame, cfg: Fusion = Fusion()) -> DataFrame:
    """Adds ``confidence_score`` (0 to 1) and ``confidence_class``; every point is primary evidence."""
    one = lambda c: F.col(c).cast("int")
    score = F.lit(cfg.psi_weight) + cfg.amplitude_weight * one("amplitude_support") + cfg.optical_weight * one("optical_support") + cfg.context_weight * one("context_support")
    if cfg.non_support_penalty is not None:
        score = score - cfg.non_support_penalty * (F.col("optical_reliable") & ~F.col("optical_support")).cast("int")
    out = points.withColumn("confidence_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))
    return out.withColumn("confidence_class", confidence_class(F.col("confidence_score"), cfg))


def confidence_class(score: Column, cfg: Fusion = Fusion()) -> Column:
    return F.when(score >= cfg.high, "high").when(score >= cfg.medium, "medium").otherwise("low")


#: Parts of a cell's side that decide most links between cells without looking at points.
PARTS = 8


#: Pairs of points of two parts that are compared as they are, and how often crowded parts are cut finer.
FEW_PAIRS, CUTS = 4096, 6


def _linked_cells(unsure: DataFrame, spots: DataFrame, step: float, q: float) -> DataFrame:
    """``(fx, fy, cx, cy)``: cells that a pair of points links, among pairs of parts that may hold one.

    ``unsure``: pairs of cells with parts ``(px, py)`` and ``(sx, sy)`` of side ``q``.  Parts with few pairs of points are compared;
    the parts of others give way to the occupied ones of an eighth of their side: a pair wholly within a step is a link,
    one wholly beyond it is none, and the rest go on, but for cells that are linked by now.
    """
    cells = ["fx", "fy", "cx", "cy"]
    idx = lambda side: {"sx": F.floor(F.col("x") / side), "sy": F.floor(F.col("y") / side)}
    links = None
    for cut in range(CUTS + 1):
        held = spots.withColumns(idx(q))
        size = held.groupBy("sx", "sy").agg(F.count("*").alias("n"))
        first = [F.col("sx").alias("px"), F.col("sy").alias("py")]
        both = unsure.join(size, ["sx", "sy"]).join(size.select(*first, F.col("n").alias("m")), ["px", "py"])
        both = stage(both.withColumn("few", F.lit(cut == CUTS) | (F.col("n") * F.col("m") <= FEW_PAIRS)), "cluster-both")
        one = held.select(*first, F.col("x").alias("ax"), F.col("y").alias("ay"))
        tested = both.where("few").join(one, ["px", "py"]).join(held, ["sx", "sy"])
        tested = tested.where(F.pow(F.col("x") - F.col("ax"), F.lit(2)) + F.pow(F.col("y") - F.col("ay"), F.lit(2)) <= step * step)
        new, crowded = tested.select(*cells).distinct(), both.where("NOT few")
        if crowded.isEmpty():
            links = new if links is None else links.unionByName(new)
            break
        new = stage(new, "cluster-links")
        links = new if links is None else links.unionByName(new)
        crowded = crowded.join(new, cells, "left_anti")
        if not cut:  # from here on places count, not points: many points at one place are not a crowd
            spots = stage(spots.select("x", "y").distinct(), "cluster-spots")
            held = spots.withColumns(idx(q))
        q /= PARTS
        finer = stage(held.select("sx", "sy", *[v.alias(f"n{k}") for k, v in idx(q).items()]).distinct(), "cluster-finer")
        pair = crowded.join(finer, ["sx", "sy"]).join(finer.select(*first, F.col("nsx").alias("npx"), F.col("nsy").alias("npy")), ["px", "py"])
        away = [F.abs(F.col(f"ns{c}") - F.col(f"np{c}")) for c in "xy"]
        near, far = F.hypot(*[F.greatest(d - 1, F.lit(0)) * q for d in away]), F.hypot(*[(d + 1) * q for d in away])
        pair = pair.where(near <= step * (1 + 1e-9)).select(*cells, *[F.col(f"n{c}").alias(c) for c in ("px", "py", "sx", "sy")], (far <= step * (1 - 1e-9)).alias("sure"))
        pair = stage(pair, "cluster-pairs")
        sure = stage(pair.where("sure").select(*cells).distinct(), "cluster-sure")
        links = links.unionByName(sure)
        unsure = stage(pair.where("NOT sure").drop("sure").join(sure, cells, "left_anti"), "cluster-unsure")
    return links.distinct()


def cluster_points(points: DataFrame, radius: float, key: str = "point_id") -> DataFrame:
    """Adds ``cluster_id``: the smallest key among points joined by steps of at most twice the radius.

    Points are hashed into cells whose diagonal is one step, so all points of a cell are one cluster and a
    cell is linked by its smallest key.  Links to cells up to two away are settled by the occupied parts
    of cells: parts that lie wholly within a step link their cells, parts wholly beyond it do not; parts between these, of
    cells that no other parts link, are cut finer as long as they are crowded, so two crowded neighbours cost their rows.
    """
    step = 2 * radius
    q = step / 2**0.5 / PARTS
    part = {"sx": F.floor(F.col("x") / q), "sy": F.floor(F.col("y") / q)}
    own = points.select(F.col(key).alias("k"), "x", "y", *[v.alias(k) for k, v in part.items()])
    own = stage(own.withColumns({"cx": F.floor(F.col("sx") / PARTS), "cy": F.floor(F.col("sy") / PARTS)}), "cluster-cells")
    heads = stage(own.groupBy("cx", "cy").agg(F.min("k").alias("head")), "cluster-heads")
    parts = stage(own.select("cx", "cy", "sx", "sy").distinct(), "cluster-parts")
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(-2, 3) for b in range(-2, 3) if (a, b) > (0, 0)]))
    sent = parts.select("*", around.alias("o")).select(F.col("cx").alias("fx"), F.col("cy").alias("fy"), F.col("sx").alias("px"), F.col("sy").alias("py"), (F.col("cx") + F.col("o.a")).alias("cx"), (F.col("cy") + F.col("o.b")).alias("cy"))
    away = [F.abs(F.col(u) - F.col(v)) for u, v in (("sx", "px"), ("sy", "py"))]
    least = F.hypot(*[F.greatest(d - 1, F.lit(0)) * q for d in away])
    most = F.hypot(*[(d + 1) * q for d in away])
    met = sent.join(parts, ["cx", "cy"]).where(least <= step * (1 + 1e-9)).withColumn("sure", most <= step * (1 - 1e-9))
    met = stage(met, "cluster-near")
    cells = ["fx", "fy", "cx", "cy"]
    sure = stage(met.where("sure").select(*cells).distinct(), "cluster-sure")
    unsure = met.where("NOT sure").join(sure, cells, "left_anti").select(*cells, "px", "py", "sx", "sy")
    found = _linked_cells(unsure, own.select("x", "y"), step, q)
    pairs = sure.unionByName(found)
    src = heads.select(F.col("cx").alias("fx"), F.col("cy").alias("fy"), F.col("head").alias("src"))
    links = pairs.join(src, ["fx", "fy"]).join(heads.withColumnRenamed("head", "dst"), ["cx", "cy"]).select("src", "dst")
    classes = connected_components(links)
    named = stage(heads.join(classes, heads["head"] == classes["node"], "left").select("cx", "cy", F.coalesce("component", "head").alias("cluster_id")), "cluster-names")
    ids = own.join(named, ["cx", "cy"]).select(F.col("k").alias(key), "cluster_id")
    return points.join(ids, key)


def cluster_stats(points: DataFrame, cfg: Fusion = Fusion()) -> DataFrame:
    """Points, mean confidence and class, centroid and box of each cluster.

    Scores are added as decimals, so a mean that equals a class's bound does so in whatever order the points come.
    """
    mean = F.sum(F.col("confidence_score").cast("decimal(18,12)")).cast("double") / F.count("confidence_score")
    out = points.groupBy("cluster_id").agg(
        F.count("*").alias("point_count"), F.round(mean, 12).alias("mean_confidence"), F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1")
    )
    return out.withColumn("confidence_class", confidence_class(F.col("mean_confidence"), cfg))


def parcel_summary(points: DataFrame, parcels: DataFrame, key: str = "rect_id") -> DataFrame:
    """Number of points in each parcel, 0 for empty ones."""
    counts = points_in_rects(points.select("x", "y"), parcels).groupBy(key).agg(F.count("*").alias("point_count"))
    return parcels.join(counts, key, "left").withColumn("point_count", F.coalesce("point_count", F.lit(0)).cast("long"))


def evaluate_points(points: DataFrame, reference: DataFrame) -> DataFrame:
    """tp, fp, fn, precision, recall, f1 of points against polygons or rectangles; joined rows count, so a double hit is two tp."""
    spots = points.groupBy("x", "y").agg(F.count("*").alias("m"))  # points of one spot have the same hits
    hits = _hits(spots, reference, []).groupBy("x", "y").agg(F.count("*").alias("hits"))
    n = spots.join(hits, ["x", "y"], "left").agg(F.coalesce(F.sum(F.col("m") * F.col("hits")), F.lit(0)).alias("tp"), F.coalesce(F.sum(F.when(F.col("hits").isNull(), F.col("m"))), F.lit(0)).alias("fp"))
    n = n.join(reference.agg(F.count("*").alias("refs")))
    n = n.select("tp", "fp", F.greatest(F.col("refs") - F.col("tp"), F.lit(0)).alias("fn"))
    n = n.withColumns({"precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), "recall": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))})
    return n.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def polygon_area(rings: Column) -> Column:
    """Area of a polygon: its outer ring, which comes first, less its holes."""
    each = F.transform(rings, lambda ring, i: F.when(i == 0, ring_area(ring)).otherwise(-ring_area(ring)))
    return F.aggregate(each, F.lit(0.0), lambda acc, v: acc + v)


def _edges(rings: Column, x: Column, y: Column) -> Column:
    """Edges seen from (x, y), left end first; ``s`` is 1 above the polygon's inside, -1 below it."""

    def of_ring(ring: Column, i: Column) -> Column:
        pairs = F.slice(F.zip_with(ring, F.slice(ring, F.lit(2), F.size(ring)), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), F.lit(1), F.size(ring) - 1)
        turn = F.aggregate(pairs, F.lit(0.0), lambda acc, e: acc + (e["a"]["x"] - x) * (e["b"]["y"] - y) - (e["b"]["x"] - x) * (e["a"]["y"] - y))
        side = F.signum(turn) * F.when(i == 0, 1.0).otherwise(-1.0)

        def edge(e: Column) -> Column:
            back = e["b"]["x"] < e["a"]["x"]
            lo, hi = F.when(back, e["b"]).otherwise(e["a"]), F.when(back, e["a"]).otherwise(e["b"])
            return F.struct((lo["x"] - x).alias("x0"), (lo["y"] - y).alias("y0"), (hi["x"] - x).alias("x1"), (hi["y"] - y).alias("y1"), F.when(back, side).otherwise(-side).alias("s"))

        return F.filter(F.transform(pairs, edge), lambda e: e["x0"] < e["x1"])

    return F.flatten(F.transform(rings, of_ring))


def overlap_area(rings: Column, others: Column) -> Column:
    """Area of the intersection of two polygons (rings: outer first, then holes), of any shape.

    A polygon is the signed sum of the strips below its edges, so the intersection's area is the signed sum, over
    pairs of edges, of what both strips hold: the integral of the lower of two lines where both edges run.
    """
    origin = rings[0][0]
    own, their = _edges(rings, origin["x"], origin["y"]), _edges(others, origin["x"], origin["y"])

    def shared(e: Column, f: Column) -> Column:
        lo, hi = F.greatest(e["x0"], f["x0"]), F.least(e["x1"], f["x1"])
        at = lambda g, x: g["y0"] + (g["y1"] - g["y0"]) * ((x - g["x0"]) / (g["x1"] - g["x0"]))
        a, b = at(e, lo) - at(f, lo), at(e, hi) - at(f, hi)
        apart = F.when(a * b < 0, (a * a + b * b) / (F.abs(a) + F.abs(b))).otherwise(F.abs(a + b))
        lower = (at(e, lo) + at(e, hi) + at(f, lo) + at(f, hi) - apart) / 4
        return F.when(hi > lo, e["s"] * f["s"] * (hi - lo) * lower).otherwise(0.0)

    return F.aggregate(own, F.lit(0.0), lambda acc, e: acc + F.aggregate(their, F.lit(0.0), lambda inner, f: inner + shared(e, f)))


def _areas(predicted: DataFrame, reference: DataFrame, met: DataFrame, area: Column, shared: Column) -> DataFrame:
    total = lambda v: F.coalesce(F.sum(v), F.lit(0.0))
    out = predicted.agg(total(area).alias("predicted_area")).join(reference.agg(total(area).alias("reference_area"))).join(met.agg(total(shared).alias("intersection_area")))
    union = F.col("predicted_area") + F.col("reference_area") - F.col("intersection_area")
    return out.withColumns({"area_delta": F.col("predicted_area") - F.col("reference_area"), "iou": F.try_divide(F.col("intersection_area"), union)})


def evaluate_rects(predicted: DataFrame, reference: DataFrame, cell: float = 500.0) -> DataFrame:
    """Areas, summed pairwise overlap and IoU of two sets of rectangles."""
    box = ("x0", "y0", "x1", "y1")
    shared = (F.least("px1", "qx1") - F.greatest("px0", "qx0")) * (F.least("py1", "qy1") - F.greatest("py0", "qy0"))
    return _areas(predicted, reference, near_pairs(predicted.select(*box), reference.select(*box), cell, touch=False), (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")), shared)


#: Pairs of polygons with at most this product of edges are measured edge by edge, others by slabs.
PRODUCT = 4096


def _paired_areas(met: DataFrame) -> DataFrame:
    """``shared`` of pairs ``(prings, pe, qe, n)``, polygons' edges as of ``_edges`` about their own first corner: ``overlap_area`` n times.

    Edges are rows here, so their sums are plain arithmetic; only the sum over all rows is of use.
    """
    both = met.withColumn("o", F.col("prings")[0][0]).select("o", "qo", "n", F.explode("pe").alias("e"), "qe").select("o", "qo", "n", "e", F.explode("qe").alias("f"))
    side = lambda e, a: {f"{e}{c}{k}": F.col(f"{e}.{c}{k}") + (F.col(f"{a}.{c}") - F.col(f"o.{c}")) for c in "xy" for k in (0, 1)}
    both = both.select("n", (F.col("e.s") * F.col("f.s")).alias("s"), *[v.alias(k) for k, v in (side("e", "o") | side("f", "qo")).items()])
    both = both.withColumns({"lo": F.greatest("ex0", "fx0"), "hi": F.least("ex1", "fx1")}).where("hi > lo")
    at = lambda g, x: F.col(f"{g}y0") + (F.col(f"{g}y1") - F.col(f"{g}y0")) * ((F.col(x) - F.col(f"{g}x0")) / (F.col(f"{g}x1") - F.col(f"{g}x0")))
    both = both.select("n", "s", (F.col("hi") - F.col("lo")).alias("w"), *[at(g, x).alias(f"{g}{x}") for g in "ef" for x in ("lo", "hi")])
    a, b = F.col("elo") - F.col("flo"), F.col("ehi") - F.col("fhi")
    apart = F.when(a * b < 0, (a * a + b * b) / (F.abs(a) + F.abs(b))).otherwise(F.abs(a + b))
    lower = (F.col("elo") + F.col("ehi") + F.col("flo") + F.col("fhi") - apart) / 4
    return both.select((F.col("n") * F.col("s") * F.col("w") * lower).alias("shared"))


def evaluate_polygons(predicted: DataFrame, reference: DataFrame, cell: float = 500.0) -> DataFrame:
    """Areas, summed pairwise overlap and IoU of two sets of polygons (column ``rings``: outer first, then holes).

    Polygons of equal rings are measured once and counted, so pairs are those of different shapes.
    """

    def shapes(df: DataFrame) -> DataFrame:
        held = stage(df.groupBy("rings").agg(F.count("*").alias("n")), "overlap-shapes")
        outer = F.col("rings")[0]
        first = F.when(F.size("rings") > 0, F.when(F.size(outer) > 0, outer[0]))
        box = [f(outer[axis]).alias(f"{axis}{n}") for axis in "xy" for n, f in ((0, F.array_min), (1, F.array_max))]
        return stage(held.select("rings", "n", first.alias("o"), F.when(first.isNotNull(), _edges(F.col("rings"), first["x"], first["y"])).alias("e"), F.size(F.flatten("rings")).cast("long").alias("m"), *box), "overlap-boxes")

    p, q = shapes(predicted), shapes(reference)
    # few rows may have many partners: they are dealt to all tasks whatever their size
    own = p.repartition(int(p.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = near_pairs(own, q, cell, touch=False)
    small = met.where(F.col("pm") * F.col("qm") <= PRODUCT)
    shared = _paired_areas(small.select("prings", "pe", "qe", "qo", (F.col("pn") * F.col("qn")).alias("n")))
    large = stage(met.where(F.col("pm") * F.col("qm") > PRODUCT).select("prings", "qrings", (F.col("pn") * F.col("qn")).alias("n")), "overlap-large")
    if not large.isEmpty():
        large = stage(large.withColumn("pair", F.monotonically_increasing_id()), "overlap-large-ids")
        found = shared_areas(large, ["pair"]).join(large.select("pair", "n"), "pair")
        shared = shared.unionByName(found.select((F.col("shared") * F.col("n")).alias("shared")))
    return _areas(p, q, shared, polygon_area(F.col("rings")) * F.col("n"), F.col("shared"))
