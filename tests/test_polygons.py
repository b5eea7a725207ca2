"""Polygons of any shape against brute force and closed forms."""

import math
import random
import time

import pytest
from changegrid.operators import catalog, spatial
from changegrid.operators import polygons as G
from changegrid.sources import io
from pyspark.sql import functions as F

RINGS = "array<array<struct<x: double, y: double>>>"


def ring(*corners):
    return [(float(x), float(y)) for x, y in (*corners, corners[0])]


def table(spark, shapes, key="k long"):
    return spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], f"{key}, rings {RINGS}")


def star(rnd, x, y, r, n):
    """A closed ring about (x, y), of any shape but without crossings."""
    return ring(*[(x + r * (0.3 + 0.7 * rnd.random()) * math.cos(2 * math.pi * k / n), y + r * (0.3 + 0.7 * rnd.random()) * math.sin(2 * math.pi * k / n)) for k in range(n)])


def holds(rings, x, y):
    """1 inside, 2 on the border, else 0."""
    odd = False
    for r in rings:
        for (ax, ay), (bx, by) in zip(r, r[1:], strict=False):
            cross = (bx - ax) * (y - ay) - (x - ax) * (by - ay)
            if cross == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return 2
            if (ay > y) != (by > y) and (cross > 0) == (by > ay):
                odd = not odd
    return int(odd)


def shoelace(r):
    return sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(r, r[1:], strict=False)) / 2


BLOCK = [ring((0, 0), (8, 0), (8, 8), (0, 8)), ring((2, 2), (2, 6), (6, 6), (6, 2))]  # with a hole
CORNER = [ring((20, 0), (30, 0), (30, 2), (22, 2), (22, 10), (20, 10))]  # concave


def test_points_in_polygons(spark):
    rnd = random.Random(1)
    shapes = [BLOCK, CORNER, [star(rnd, 50, 50, 40, 300)], [star(rnd, 10, 10, 5, 7)], [star(rnd, 500, 500, 450, 90), ring((495, 495), (505, 495), (505, 505), (495, 505))], [[]], None]
    points = [(float(x), float(y)) for x in range(-1, 32) for y in range(-1, 12)] + [(rnd.random() * 1000, rnd.random() * 1000) for _ in range(600)] + [(rnd.random() * 100, rnd.random() * 100) for _ in range(400)] + [(None, 1.0), (4.0, 1.0)]
    table_of_points = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i long, x double, y double")
    for cell in (3.0, 500.0):
        got = {(r.i, r.k) for r in G.points_in_polygons(table_of_points, table(spark, shapes), ["k"], cell).collect()}
        assert got == {(i, k) for i, (x, y) in enumerate(points) if x is not None for k, s in enumerate(shapes) if s and holds(s, x, y)}
    border = {(r.x, r.y) for r in G.spots_in_polygons(table_of_points, table(spark, [BLOCK]), ["k"]).where("border").collect()}
    assert border == {p for p in points if p[0] is not None and holds(BLOCK, *p) == 2}


def test_cover_is_bounded(spark, monkeypatch):
    """The rows of a polygon's cover do not grow with it, and places in its inner cells meet no edge."""
    seen, keep = {}, G.stage
    monkeypatch.setattr(G, "stage", lambda df, name: seen.setdefault(name, keep(df, name)) if name == "polygon-cover" else keep(df, name))
    big = [ring(*[(1e6 * math.cos(k * math.pi / 2000), 1e6 * math.sin(k * math.pi / 2000)) for k in range(4000)])]
    points = spark.range(2000).selectExpr("cos(id) * 9e5 * id / 2000 AS x", "sin(id) * 9e5 * id / 2000 AS y")
    assert G.points_in_polygons(points, table(spark, [big]), ["k"], 1.0).count() == 2000
    cover = seen["polygon-cover"]
    assert cover.count() <= 17 * 17 + 34 and cover.where("NOT near").count() > 100


def test_polygons_meet(spark):
    rnd = random.Random(2)
    area = [ring((0, 0), (30, 0), (30, 5), (5, 5), (5, 30), (0, 30))]  # concave: its box meets more than it does
    scenes = [[ring((10, 10), (20, 10), (20, 20), (10, 20))], [ring((4, 4), (8, 4), (8, 8), (4, 8))], [ring((1, 1), (2, 1), (2, 2), (1, 2))], [ring((-9, -9), (99, -9), (99, 99), (-9, 99))], [ring((5, 30), (9, 30), (9, 40), (5, 40))], [ring((3, 3), (5, 3), (5, 5), (3, 5))]]
    hole = [ring((-50, -50), (60, -50), (60, 60), (-50, 60)), ring((9, 9), (9, 21), (21, 21), (21, 9))]
    got = {(r.k, r.a) for r in G.polygons_meet(table(spark, scenes), table(spark, [area, hole], "a long"), "k", "a", 7.0).collect()}
    assert got == {(k, 0) for k in range(1, 6)} | {(k, 1) for k in range(1, 6)}
    ours, theirs = ([[star(rnd, rnd.random() * 100, rnd.random() * 100, 8, 9)] for _ in range(40)] for _ in range(2))

    def brute(p, q):
        segs = [list(zip(r, r[1:], strict=False)) for r in (p[0], q[0])]
        turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        cross = any(turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0 for a, b in segs[0] for c, d in segs[1])
        return cross or holds(q, *p[0][0]) or holds(p, *q[0][0])

    got = {(r.k, r.a) for r in G.polygons_meet(table(spark, ours), table(spark, theirs, "a long"), "k", "a", 5.0).collect()}
    assert got == {(i, j) for i, p in enumerate(ours) for j, q in enumerate(theirs) if brute(p, q)} and len(got) > 20


def test_dissolve(spark):
    cases = {
        "holes and overlaps": ([BLOCK, [ring((4, -2), (5, -2), (5, 10), (4, 10))], CORNER], 48 + 12 - 4 + 36, None),
        "equal and side by side": ([[ring((0, 0), (4, 0), (4, 4), (0, 4))]] * 3 + [[ring((4, 0), (8, 0), (8, 4), (4, 4))], [ring((2, 4), (6, 4), (6, 9), (2, 9))]], 32 + 20, 1),
        "one in another": ([[ring((0, 0), (9, 0), (9, 9), (0, 9))], [ring((3, 3), (3, 5), (5, 5), (5, 3))]], 81, 1),
        "a hole filled": ([BLOCK, [ring((2, 2), (6, 2), (6, 6), (2, 6))]], 64, 1),
        "corner on corner": ([[ring((0, 0), (2, 0), (2, 2), (0, 2))], [ring((2, 2), (4, 2), (4, 4), (2, 4))]], 8, 2),
        "far coordinates": ([[ring((500000, 4000000), (500010, 4000000), (500010, 4000010), (500000, 4000010))], [ring((500005, 4000005), (500020, 4000005), (500020, 4000020), (500005, 4000020))]], 100 + 225 - 25, 1),
    }
    for name, (shapes, area, rings) in cases.items():
        row = G.dissolve(table(spark, shapes), 3.0).first()
        assert row.area == pytest.approx(area), name
        assert sum(shoelace([(p.x, p.y) for p in r]) for r in row.rings) == pytest.approx(area), name
        assert rings is None or len(row.rings) == rings, name
    assert G.dissolve(table(spark, []).where("k > 9")).count() == 0


def test_dissolve_by_points(spark):
    """A place lies in the union if and only if it lies in one of the shapes."""
    rnd = random.Random(3)
    shapes = [[star(rnd, rnd.random() * 60, rnd.random() * 60, 15, 11)] for _ in range(25)]
    row = G.dissolve(table(spark, shapes), 6.0).first()
    whole = [[(p.x, p.y) for p in r] for r in row.rings]
    points = [(rnd.random() * 90 - 15, rnd.random() * 90 - 15) for _ in range(1500)]
    assert [bool(holds(whole, *p)) for p in points] == [any(holds(s, *p) for s in shapes) for p in points]
    again = G.dissolve(spark.createDataFrame([(0, whole[:1])], f"k long, rings {RINGS}"), 6.0).first()
    assert again.area == pytest.approx(shoelace(whole[0]))


def test_dissolve_of_boxes_in_line(spark):
    """Boxes of many widths with sides in line and moved ones, in any order: crossings of one place are one corner."""
    rnd = random.Random(5)
    boxes = [(x, y, x + 300 + 10 * n, y + 400) for n in range(25) for x, y in ((0, 0), (3000, 7000))]
    boxes += [(a + 100, b + 50, c + 100, d + 50) for a, b, c, d in boxes]
    xs, ys = (sorted({v for box in boxes for v in box[i::2]}) for i in (0, 1))
    held = {(x0, y0): (x1 - x0) * (y1 - y0) for x0, x1 in zip(xs, xs[1:], strict=False) for y0, y1 in zip(ys, ys[1:], strict=False) for a, b, c, d in boxes if a <= x0 and x1 <= c and b <= y0 and y1 <= d}
    for _ in range(2):
        rnd.shuffle(boxes)
        row = G.dissolve(table(spark, [[ring((a, b), (c, b), (c, d), (a, d))] for a, b, c, d in boxes]).repartition(7)).first()
        assert row.area == sum(held.values()) and len(row.rings) == 2


def test_dissolve_of_copies(spark):
    """3,000 copies of two shapes are two shapes."""
    begun = time.time()
    row = G.dissolve(spark.range(3000).join(table(spark, [BLOCK, CORNER])).select("rings")).first()
    assert row.area == 48 + 36 and len(row.rings) == 3 and time.time() - begun < 60


def test_area_shape(spark, tmp_path):
    """A vector file of overlapping shapes and one apart is one shape; its box meets a scene that it does not."""
    io.write_vector(table(spark, [BLOCK, [ring((6, 6), (12, 6), (12, 12), (6, 12))], CORNER]), f"{tmp_path}/aoi.geojson")
    shape = io.area_shape(spark, f"{tmp_path}/aoi.geojson")
    row = shape.first()
    assert row.area == pytest.approx(48 + 36 - 4 + 36) and len(row.rings) == 3
    assert io.area_shape(spark, (1, 2, 4, 6)).first().area == 12
    boxes = [("in", 7.0, 7.0, 9.0, 9.0), ("hole", 3.0, 3.0, 5.0, 5.0), ("bay", 23.0, 3.0, 29.0, 9.0), ("part", 25.0, -1.0, 26.0, 1.0), ("far", 90.0, 90.0, 91.0, 91.0)]
    scenes = spark.createDataFrame(boxes, "scene_id string, x0 double, y0 double, x1 double, y1 double")
    assert {r.scene_id for r in catalog.meets_area(scenes, shape).collect()} == {"in", "part"}


def test_large_polygons_are_evaluated_by_slabs(spark):
    n = 120
    round_ = lambda x: [ring(*[(x + 10 * math.cos(2 * math.pi * k / n), 10 * math.sin(2 * math.pi * k / n)) for k in range(n)])]
    small = [ring((-1, -1), (1, -1), (1, 1), (-1, 1))]
    both = spatial.evaluate_polygons(table(spark, [round_(0.0), small]), table(spark, [round_(5.0), small])).first()
    whole = n / 2 * 100 * math.sin(2 * math.pi / n)
    lens = 2 * 100 * math.acos(0.25) - 2.5 * math.sqrt(400 - 25)  # of circles; polygons differ by parts in a thousand
    assert both.predicted_area == pytest.approx(whole + 4) and both.intersection_area == pytest.approx(lens + 4 + 4 + 4, rel=2e-3)


def test_copies_are_evaluated_once(spark):
    """2,000 copies against 2,000 are one pair of shapes that counts four million times; a shape without corners is none."""
    copies = lambda dx, shape: spark.range(2000).select(F.lit(dx).alias("d")).join(table(spark, [[[(x + dx, y + dx) for x, y in r] for r in shape]]).select("rings"))
    other = table(spark, [CORNER, [[]]]).select("rings")
    begun = time.time()
    row = spatial.evaluate_polygons(copies(0.0, BLOCK).select("rings").unionByName(other), copies(4.0, BLOCK).select("rings").unionByName(other)).first()
    assert row.intersection_area == pytest.approx(2000 * 2000 * 8 + 36) and row.predicted_area == row.reference_area == pytest.approx(2000 * 48 + 36)
    assert time.time() - begun < 60


def test_points_in_rings_of_any_kind(spark):
    """Convex rings both ways, with corners in line and twice, concave, crossing, open and long ones, some of them many times."""
    rnd = random.Random(3)
    quad = ring((0, 0), (9, 3), (12, 12), (3, 9))
    kinds = [quad, quad[::-1], ring((0, 0), (6, 0), (12, 0), (12, 12), (0, 12)), ring((0, 0), (0, 0), (12, 0), (6, 12)), ring((0, 0), (12, 0), (6, 6), (12, 12), (0, 12)), ring((0, 0), (12, 12), (12, 0), (0, 12))]
    kinds += [ring((6, 0), (10, 12), (0, 4), (12, 4), (2, 12)), quad[:-1], ring((0, 0), (12, 0), (6, 12), (0, 0), (12, 0), (6, 12)), ring((3, 3), (9, 9)), [(6.0, 6.0)], star(rnd, 6, 6, 6, 20), star(rnd, 6, 6, 6, 8)]
    kinds.append(ring(*[(6 + 6 * math.cos(math.pi * k / 15), 6 + 6 * math.sin(math.pi * k / 15)) for k in range(30)]))
    shapes = [(i, k, kinds[k]) for i, k in enumerate(list(range(len(kinds))) * 3)]
    polygons = spark.createDataFrame([*shapes, (-1, -1, None), (-2, -2, [])], "k long, kind long, ring array<struct<x: double, y: double>>")
    spots = [(i, float(i % 13), float(i // 13)) for i in range(169)]
    got = sorted((r.id, r.k, r.kind) for r in spatial.points_in_rings(spark.createDataFrame(spots, "id long, x double, y double"), polygons, 5.0).collect())
    assert got == sorted((i, k, kind) for i, x, y in spots for k, kind, r in shapes if holds([r], x, y))


def test_points_in_copies_of_rings(spark):
    """20,000 points in 400 copies of each of 15 rings."""
    side = F.lit(100.0) + F.col("id") % 15
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    none = F.lit(0.0)
    polygons = spark.range(6000).select("id", F.array(corner(none, -side), corner(side, none), corner(none, side), corner(-side, none), corner(none, -side)).alias("ring"))
    points = spark.range(20000).select(F.col("id").alias("p"), (F.col("id") % 100 - 50.0).alias("x"), (F.col("id") % 97 - 48.0).alias("y"))
    begun = time.time()
    found = spatial.points_in_rings(points, polygons).count()
    assert found == sum(400 * (abs(i % 100 - 50) + abs(i % 97 - 48) <= 100 + s) for i in range(20000) for s in range(15))
    assert time.time() - begun < 40


def test_shared_areas(spark):
    """Squares with holes, of known overlap; then 20,000 edges each, in seconds."""
    moved = [[(x + 4, y + 4) for x, y in r] for r in BLOCK]
    pairs = [(1, BLOCK, BLOCK), (2, BLOCK, moved), (3, BLOCK, CORNER), (4, BLOCK, [ring((0, 0), (8, 8), (0, 8))])]
    got = {r.k: r.shared for r in G.shared_areas(spark.createDataFrame(pairs, f"k long, prings {RINGS}, qrings {RINGS}"), ["k"]).collect()}
    assert {k: round(v, 9) for k, v in got.items()} == {1: 48, 2: 8.0, 3: 0, 4: 24}
    n = 20000
    wave = lambda phase: [ring((0, 0), (n, 0), *[(n - i, 50 + 10 * math.sin(i * 0.01 + phase) + (i % 2)) for i in range(n + 1)])]
    p, q = wave(0.0), wave(1.0)
    tops = [[dict(r[0]) for r in (s,)][0] for s in (p, q)]
    want = sum((min(tops[0][i], tops[1][i]) + min(tops[0][i + 1], tops[1][i + 1])) / 2 for i in range(1, n - 1))
    begun = time.time()
    got = G.shared_areas(spark.createDataFrame([(1, p, q)], f"k long, prings {RINGS}, qrings {RINGS}"), ["k"]).first().shared
    assert got == pytest.approx(want, rel=1e-3) and time.time() - begun < 60
