"""Unions of discs against pixel counts and closed forms."""

import math
import random

import numpy as np
import pytest

from changegrid.operators import discs as D


def unions(spark, groups, radius):
    rows = [(g, float(x), float(y)) for g, pts in groups.items() for x, y in pts]
    found = D.disc_unions(spark.createDataFrame(rows, "g long, x double, y double"), radius, ["g"])
    return {r.g: r for r in found.collect()}


def pixels(points, radius, step):
    """Area of the union as a count of pixels."""
    p = np.array(sorted(set(points)))
    lo, hi = p.min(0) - radius, p.max(0) + radius
    x, y = np.meshgrid(np.arange(lo[0], hi[0], step) + step / 2, np.arange(lo[1], hi[1], step) + step / 2)
    inside = np.zeros(x.shape, bool)
    for a, b in p:
        inside |= (x - a) ** 2 + (y - b) ** 2 <= radius**2
    return inside.sum() * step * step


def shoelace(ring):
    return sum(a.x * b.y - b.x * a.y for a, b in zip(ring, ring[1:], strict=False)) / 2


def test_closed_forms(spark):
    r, d = 6.0, 5.0
    lens = 2 * r * r * math.acos(d / 2 / r) - d / 2 * math.sqrt(4 * r * r - d * d)
    around = [(20 * math.cos(k * math.pi / 6), 20 * math.sin(k * math.pi / 6)) for k in range(12)]
    groups = {1: [(500000.0, 3700000.0)] * 3, 2: [(0, 0), (d, 0)], 3: around, 4: [(0, 0), (12, 0)], 5: [(0, 0), (100, 0)], 6: [(i * 6.0, j * 6.0) for i in range(4) for j in range(4)]}
    got = unions(spark, groups, r)
    assert got[1].area == pytest.approx(math.pi * 36) and got[1].perimeter == pytest.approx(math.pi * 12) and len(got[1].rings) == 1
    assert got[2].area == pytest.approx(2 * math.pi * 36 - lens) and got[2].perimeter == pytest.approx(4 * r * (math.pi - math.acos(d / 2 / r)))
    assert len(got[3].rings) == 2 and got[3].area == pytest.approx(pixels(groups[3], r, 0.02), rel=2e-3)  # a hole
    assert got[4].area == pytest.approx(2 * math.pi * 36) and len(got[4].rings) == 2  # they touch
    assert len(got[5].rings) == 2 and len(got[6].rings) == 1  # four discs meet in a point
    for row in got.values():
        parts = [shoelace(x) for x in row.rings]
        assert all(x[0] == x[-1] for x in row.rings) and sum(parts) == pytest.approx(row.area, rel=4e-3) and parts[0] > max(parts) - 1e-6


@pytest.mark.parametrize("seed,n,side", [(1, 40, 40), (2, 150, 60), (3, 300, 50)])
def test_random_unions(spark, seed, n, side):
    rnd = random.Random(seed)
    points = [(rnd.random() * side, rnd.random() * side) for _ in range(n)]
    row = unions(spark, {1: points}, 5.0)[1]
    assert row.area == pytest.approx(pixels(points, 5.0, 0.05), rel=2e-3)
    assert sum(shoelace(x) for x in row.rings) == pytest.approx(row.area, rel=5e-3)
    length = sum(math.dist((a.x, a.y), (b.x, b.y)) for x in row.rings for a, b in zip(x, x[1:], strict=False))
    assert length == pytest.approx(row.perimeter, rel=2e-3)


def test_crowded_discs(spark):
    """30,000 discs within a metre: their pairs, 4.5 x 10^8, are not made; the union is that of the outermost."""
    rnd = random.Random(5)
    points = [(rnd.gauss(0, 0.3), rnd.gauss(0, 0.3)) for _ in range(30000)]
    table = spark.createDataFrame([(1, x, y) for x, y in points], "g long, x double, y double")
    held = D._thinned(table.withColumn("id", D.F.monotonically_increasing_id()), 5.0, ["g"])
    assert held.count() < 1500
    row = D.union_measures(D.border_arcs(table, 5.0, ["g"]), 5.0, ["g"]).first()
    far = sorted(points, key=lambda p: -math.hypot(*p))[:400]
    few = D.union_measures(D.border_arcs(spark.createDataFrame([(1, x, y) for x, y in far], "g long, x double, y double"), 5.0, ["g"]), 5.0, ["g"]).first()
    assert row.area == pytest.approx(few.area, rel=1e-4) and row.area >= few.area - 1e-9
    assert D.disc_unions(table.where("g > 1"), 5.0, ["g"]).count() == 0
