"""Zone outlines across tiles against whole-ring forms; places along rings."""

import random

import outlines
import pytest

from changegrid.operators import zones as Z
from changegrid.operators.chains import rank_cycles
from changegrid.operators.ordering import number_rows


def mask(spark, cells):
    return spark.createDataFrame(sorted(cells), "r int, c int")


def whole(lines, tolerance, res=10.0):
    """Rings of one zone, traced and simplified in one piece."""
    traced = [[(x * res, -y * res) for x, y in ring] for ring in outlines.link_rings(lines)]
    rings, t = traced, tolerance
    while t > 0:
        rings = [outlines.simplify(ring, t) for ring in traced]
        if not outlines.crossing(rings):
            break
        rings, t = traced, t / 2 if t > tolerance / 16 else 0
    return rings


def lines_of(labels):
    found = {}
    for r in Z.border_lines(labels).collect():
        found.setdefault((r.comp_r, r.comp_c), []).append(((r.ax, r.ay), (r.bx, r.by)))
    return found


@pytest.mark.parametrize("tolerance,fill", [(5.0, 0.62), (12.0, 0.7), (40.0, 0.8)])
def test_outlines_across_tiles(spark, tolerance, fill):
    """Random masks with holes and corner contacts, linked in tiles of 4 pixels."""
    rnd = random.Random(int(tolerance))
    labels = Z.label_zones(mask(spark, {(r, c) for r in range(22) for c in range(22) if rnd.random() < fill}), tile=8)
    labels = spark.createDataFrame(labels.collect(), labels.schema)
    got = {(r.comp_r, r.comp_c): r for r in Z.zone_outlines(labels, tolerance_m=tolerance, link_tile=4).collect()}
    want = {k: whole(v, tolerance) for k, v in lines_of(labels).items()}
    assert got.keys() == want.keys()
    for k, rings in want.items():
        found = [[(p.x, p.y) for p in ring] for ring in got[k].rings]
        assert sorted(found) == sorted(rings) and abs(outlines._area(found[0])) == max(abs(outlines._area(x)) for x in rings)
        area = abs(outlines._area(rings[0])) - sum(abs(outlines._area(x)) for x in rings[1:])
        assert got[k].simplified_area_ha == pytest.approx(area / 10000) and got[k].simplified_perim_m == pytest.approx(sum(map(outlines._length, rings)))
        assert got[k].n_vertices == sum(map(len, rings)) and got[k].wkt.startswith("POLYGON ((") and got[k].wkt.count("(") == len(rings) + 1
    assert Z.zone_outlines(labels.where("r < 0"), tolerance_m=tolerance).count() == 0


def test_a_zone_over_all_tiles(spark):
    """A comb whose one outer ring winds through every tile; in chunks it stays within the tolerance and the topology."""
    cells = {(r, c) for r in range(60) for c in range(60) if c % 4 < 2 or r < 2 or (r > 57 and c % 8 < 4)}
    labels = Z.label_zones(mask(spark, cells), tile=16)
    labels = spark.createDataFrame(labels.collect(), labels.schema)
    (want,) = [whole(v, 0.0) for v in lines_of(labels).values()]
    ranked = Z.ring_corners(labels, link_tile=4).collect()
    assert len(ranked) == sum(map(len, want)) - len(want) and {r.n for r in ranked} == {len(x) - 1 for x in want}
    for chunk in (7, 1 << 15):
        shape = Z.zone_outlines(labels, 1.0, tolerance_m=0.0, link_tile=4, chunk=chunk).first()
        assert sorted([(p.x * 10, p.y * 10) for p in ring] for ring in shape.rings) == sorted(want)
    shape = Z.zone_outlines(labels, 1.0, tolerance_m=0.4, link_tile=4, chunk=7).first()
    assert abs(shape.simplified_area_ha * 10000 - len(cells)) < 1e-6 and not outlines.crossing([[(p.x, p.y) for p in ring] for ring in shape.rings])


def test_large_coordinates_keep_their_digits(spark):
    shape = Z.zone_outlines(Z.label_zones(mask(spark, {(0, 0), (0, 1)})), 0.5, 512345.25, 3654321.5).first()
    assert shape.wkt == "POLYGON ((512345.25 3654321.5, 512346.25 3654321.5, 512346.25 3654321, 512345.25 3654321, 512345.25 3654321.5))"
    assert shape.simplified_area_ha == 0.5 / 10000


def test_rank_cycles(spark):
    """Rings of every size, cut at buckets in every way."""
    rnd = random.Random(9)
    ids, rows, want = list(range(400)), [], {}
    rnd.shuffle(ids)
    while ids:
        ring = [ids.pop() for _ in range(min(len(ids), rnd.choice([1, 2, 5, 90])))]
        low = {i: rnd.randrange(20) for i in ring}
        head = min(range(len(ring)), key=lambda k: (low[ring[k]], ring[k]))
        for k, i in enumerate(ring):
            rows.append((i, ring[(k + 1) % len(ring)], low[i], rnd.randrange(7) if len(ring) > 2 else 0))
            want[i] = (ring[head], (k - head) % len(ring), len(ring))
    got = rank_cycles(spark.createDataFrame(rows, "id long, next long, low long, b long"), ["b"])
    assert {r.id: (r.ring, r.place, r.n) for r in got.collect()} == want
    assert rank_cycles(spark.createDataFrame([], "id long, next long, low long, b long"), ["b"]).count() == 0


def test_number_rows(spark):
    """Numbers as a window would give them, over many partitions, with null keys, ties apart and empty tables."""
    rows = spark.range(0, 3000, 1, 5).selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE id % 3 END AS g", "pmod(xxhash64(id), 100000) * 3000 + id AS v")
    got = number_rows(rows, ["v"], ["g"], "n").collect()
    for g in {r.g for r in got}:
        assert [r.n for r in sorted((r for r in got if r.g == g), key=lambda r: r.v)] == list(range(1, 1 + sum(r.g == g for r in got)))
    assert [r.number for r in sorted(number_rows(rows, ["v"]).collect(), key=lambda r: r.v)] == list(range(1, 3001))
    assert number_rows(rows.where("v < 0"), ["v"], ["g"]).count() == 0
