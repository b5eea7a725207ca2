import datetime as dt
import math
import random
import time

import outlines
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from changegrid.config import ChangeTest, Cleaning, ZoneShape, radius_pixels
from changegrid.functions import bandmath as B
from changegrid.functions import geo
from changegrid.operators import catalog as C
from changegrid.operators import neighborhood as N
from changegrid.operators import pixels as P
from changegrid.operators import psi as S
from changegrid.operators import raster as R
from changegrid.operators import spatial as X
from changegrid.operators import zones as Z
from changegrid.operators.components import connected_components
from changegrid.plans.pipelines import BuiltUp, evaluate_builtup, run_builtup, run_psi


def grid(spark, cells):
    return spark.createDataFrame([(r, c) for r, c in cells], "r int, c int")


def cells(df):
    return {(r.r, r.c) for r in df.collect()}


def radar(spark, block, size=8):
    rows = []
    for r in range(size):
        for c in range(size):
            hit = (r, c) in block
            rows += [("p1", "before", r, c, 1.0, 1.0), ("p1", "after", r, c, 8.0 if hit else 1.0, 1.3 if hit else 1.0)]
    return spark.createDataFrame(rows, "period_id string, phase string, r int, c int, vv double, vh double")


BLOCK = {(r, c) for r in (2, 3, 4) for c in (2, 3, 4)}


def test_block_is_kept_and_lone_pixel_goes(spark):
    tested = R.change_test(R.s1_composite(radar(spark, BLOCK)))
    assert cells(Z.detect(tested, 8, 8, Cleaning(closing_m=0), tile=4)) == BLOCK
    alone = R.change_test(R.s1_composite(radar(spark, {(3, 3)})))
    assert Z.detect(alone, 8, 8, tile=4).isEmpty()


def test_level_of_the_test_decides_candidates(spark):
    obs = radar(spark, BLOCK)
    n = [R.change_test(R.s1_composite(obs), ChangeTest(alpha=a)).where("candidate").count() for a in (1e-6, 1e-4, 0.01, 0.9)]
    p = R.change_test(R.s1_composite(obs)).where("r = 3 AND c = 3").first().pvalue
    assert n == [9 * (p < a) for a in (1e-6, 1e-4, 0.01, 0.9)] and len(set(n)) == 2
    assert abs(ChangeTest().statistic_min - 6.634896601021213) < 1e-9


def test_missing_phase_is_no_candidate(spark):
    obs = radar(spark, BLOCK).where("NOT (r = 2 AND c = 2 AND phase = 'before')")
    row = R.change_test(R.s1_composite(obs)).where("r = 2 AND c = 2").first()
    assert (row.ratio_vv, row.statistic, row.candidate) == (None, None, False)


def test_pvalue_matches_erfc(spark):
    stats = [0.0, 0.5, 3.84, 6.63, 20.0, 55.0]
    got = spark.createDataFrame([(s,) for s in stats], "s double").select(B.chi2_tail(F.col("s"))).collect()
    assert all(abs(g[0] - math.erfc(math.sqrt(s / 2))) <= 2e-7 * math.erfc(math.sqrt(s / 2)) for g, s in zip(got, stats, strict=True))


def test_radius_rounds_half_to_even():
    assert (radius_pixels(5, 10), radius_pixels(5, 10, 1), radius_pixels(15, 10)) == (0, 1, 2)


def test_fusion_decisions(spark):
    det = spark.createDataFrame([("p", 0, i, True, 3.0 if i == 2 else 1.6, 1.3, 1e-4 if i == 2 else 5e-3) for i in range(4)], "period_id string, r int, c int, candidate boolean, ratio_vv double, ratio_vh double, pvalue double")
    sup = spark.createDataFrame([("p", 0, 0, False, False), ("p", 0, 1, True, True), ("p", 0, 2, False, True), ("p", 0, 3, False, True)], "period_id string, r int, c int, support boolean, reliable boolean")
    got = R.soft_fusion(det, sup).orderBy("c").collect()
    assert [(r.refined, r.decision) for r in got] == [(True, 1), (True, 2), (True, 3), (False, 4)]
    assert [r.n for r in R.decision_histogram(R.soft_fusion(det, sup)).orderBy("decision").collect()] == [0, 1, 1, 1, 1]


@pytest.mark.parametrize("seed", [1, 2])
def test_morphology_against_brute_force(spark, seed):
    rnd, n = random.Random(seed), 12
    mask = {(r, c) for r in range(n) for c in range(n) if rnd.random() < 0.45}
    disk = N.disk(1)
    inside = lambda p: 0 <= p[0] < n and 0 <= p[1] < n
    grown = {q for r, c in mask for q in ((r + a, c + b) for a, b in disk) if inside(q)}
    shrunk = {(r, c) for r in range(n) for c in range(n) if all((r + a, c + b) in grown for a, b in disk)}
    assert cells(N.dilate(grid(spark, mask), 1, n, n)) == grown
    assert cells(N.close(grid(spark, mask), 1, n, n)) == shrunk
    dense = {(r.r, r.c): round(r.density, 9) for r in N.disk_density(grid(spark, mask), 2, n, n).collect()}
    want = {(r, c): round(k / 13, 9) for r in range(n) for c in range(n) if (k := sum((r + a, c + b) in mask for a, b in N.disk(2)))}
    assert dense == want


@pytest.mark.parametrize("eight", [True, False])
def test_components_against_brute_force(spark, eight):
    rnd, n = random.Random(5), 24
    mask = {(r, c) for r in range(n) for c in range(n) if rnd.random() < 0.5}
    label = {}
    for start in sorted(mask):
        if start in label:
            continue
        todo = [start]
        while todo:
            r, c = todo.pop()
            if (r, c) in label:
                continue
            label[r, c] = start
            todo += [q for a in (-1, 0, 1) for b in (-1, 0, 1) if (eight or not a * b) and (q := (r + a, c + b)) in mask]
    got = {(x.r, x.c): (x.comp_r, x.comp_c) for x in P.label_components(grid(spark, mask), eight=eight, tile=5).collect()}
    assert got == label


def test_graph_components_on_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).isEmpty()


def test_zone_metrics_outline_and_corner_contact(spark):
    nine = Z.label_zones(grid(spark, BLOCK), tile=2)
    m = Z.keep_zones(Z.zone_metrics(nine)).collect()
    assert [(round(x.area_ha, 6), x.perim_m, x.zone_id) for x in m] == [(0.09, 120.0, 1)]
    corner = Z.label_zones(grid(spark, [(0, 0), (1, 1)]))
    assert corner.select("comp_r").distinct().count() == 2
    sixteen = {(r, c) for r in range(1, 5) for c in range(1, 5)}
    shape = Z.zone_outlines(Z.label_zones(grid(spark, sixteen), tile=3)).first()
    assert (round(shape.simplified_area_ha, 6), shape.n_vertices) == (0.16, 5)
    holed = Z.label_zones(grid(spark, {(r, c) for r in range(3) for c in range(3) if (r, c) != (1, 1)}))
    shape = Z.zone_outlines(holed, 1.0, tolerance_m=0).first()
    assert [abs(outlines._area([(p.x, p.y) for p in ring])) for ring in shape.rings] == [9, 1]


@pytest.mark.parametrize("seed", [3, 4])
def test_outlines_against_pixels(spark, seed):
    """Rings without simplification have the area and perimeter of the pixels, and no ring of a zone runs into a corner twice to join."""
    rnd, n = random.Random(seed), 20
    labels = Z.label_zones(grid(spark, {(r, c) for r in range(n) for c in range(n) if rnd.random() < 0.6}), tile=6)
    want = {(x.comp_r, x.comp_c): (round(x.area_ha, 9), round(x.perim_m, 6)) for x in Z.zone_metrics(labels).collect()}
    shapes = Z.zone_outlines(labels, tolerance_m=0).collect()
    assert {(x.comp_r, x.comp_c): (round(x.simplified_area_ha, 9), round(x.simplified_perim_m, 6)) for x in shapes} == want
    for shape in shapes:
        for ring in ([(p.x, p.y) for p in x] for x in shape.rings):
            assert ring[0] == ring[-1] and all((a[0] == b[0]) != (b[0] == c[0]) for a, b, c in zip(ring, ring[1:], [*ring[2:], ring[1]], strict=False))


def test_wide_disks(spark):
    """A radius beyond the grid's own size, and repeated pixels."""
    n, mask = 9, [(0, 0), (4, 5), (4, 5), (8, 8)]
    dense = {(r.r, r.c): round(r.density * len(N.disk(6))) for r in N.disk_density(grid(spark, mask), 6, n, n).collect()}
    assert dense == {(r, c): k for r in range(n) for c in range(n) if (k := sum((r - a) ** 2 + (c - b) ** 2 <= 36 for a, b in set(mask)))}


def test_polygons_are_measured_after_simplification(spark):
    """A long strip with a one-pixel step: simplification cuts the step, and the filter sees the new measures."""
    strip = {(0, c) for c in range(12)} | {(1, c) for c in range(7)}
    labels = Z.label_zones(grid(spark, strip))
    raw, cut = Z.zone_metrics(labels).first(), Z.zone_polygons(labels, ZoneShape(tolerance_m=8.0)).first()
    assert cut.perim_m < raw.perim_m and abs(cut.compactness - 4 * math.pi * cut.area_ha * 1e4 / cut.perim_m**2) < 1e-9
    edge = ZoneShape(tolerance_m=8.0, least_ha=(raw.area_ha + cut.area_ha) / 2)
    assert (Z.zone_polygons(labels, edge).count() == 1) == (cut.area_ha > raw.area_ha)


def test_simplification_keeps_the_topology():
    assert outlines.crossing([[(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]])
    assert not outlines.crossing([[(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)], [(3, 3), (3, 5), (5, 5), (5, 3), (3, 3)]])
    assert outlines.crossing([[(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)], [(8, 3), (8, 5), (12, 5), (12, 3), (8, 3)]])
    ring = [(x, (x % 2) * 0.1) for x in range(3000)] + [(3000, 50), (0, 50), (0, 0)]
    assert len(outlines.simplify(ring, 1.0)) <= 7


def test_records_of_items_and_radar_filters(spark):
    rows = [("a", "2024-01-02T03:04:05Z", {"sat:orbit_state": "", "orbit_state": "Ascending", "sat:relative_orbit": "7", "sar:polarizations": '["VV","VH"]', "sar:instrument_mode": "IW", "platform": "sentinel-1a"}), ("b", "2024-01-03T00:00:00Z", {"start_datetime": "2024-01-02T23:59:59Z", "end_datetime": "2024-01-03T00:00:09Z", "polarisationChannels": "VV", "processing_level": "L1"})]
    got = {r.scene_id: r for r in C.scene_records(spark.createDataFrame(rows, "id string, datetime string, properties map<string,string>")).collect()}
    assert (got["a"].direction, got["a"].relative_orbit, got["a"].polarization, got["a"].acquisition_stop) == ("ascending", 7, "VH+VV", "2024-01-02T03:04:05Z")
    assert (got["b"].polarization, got["b"].day, got["b"].level, got["b"].direction) == ("VV", dt.date(2024, 1, 2), "L1", None)
    scenes = spark.createDataFrame([("a", "S-1A", "ascending", "VV+VH", "IW"), ("b", "s_1a", "ascending", "VV", "IW"), ("c", "s1a", "ascending", "VV+VH", "EW")], "scene_id string, platform string, direction string, polarization string, mode string")
    assert [r.scene_id for r in C.filter_radar(scenes, "S1A", "ascending", ("vv", "v-h"), mode="IW").collect()] == ["a"]


def test_stack_predicates(spark):
    base = ("ascending", 1, "VV", "IW", "L1", "SLC")
    odd = {"ok": base, "null": (*base[:4], None, None), "hh": ("ascending", 1, "HH", "IW", "L1", "SLC"), "ew": (*base[:3], "EW", "L1", "SLC"), "l2": (*base[:4], "L2", "SLC"), "grd": (*base[:5], "GRD"), "none": (None, *base[1:])}
    scenes = spark.createDataFrame([(k, dt.date(2024, 1, 1), *v) for k, v in odd.items()], "scene_id string, day date, direction string, relative_orbit int, polarization string, mode string, level string, product_type string")
    stack = lambda pol: spark.createDataFrame([("s", "ascending", 1, pol)], "stack_id string, direction string, relative_orbit int, polarization string")
    pick = lambda pol: sorted(r.scene_id for r in C.stack_scenes(scenes, stack(pol)).collect())
    assert (pick("VV"), pick("VH"), pick("VV+VH")) == (["null", "ok"], [], ["hh", "null", "ok"])
    with pytest.raises(ValueError, match="fewer than 3"):
        C.require_scenes(C.stack_scenes(scenes, stack("VV")), stack("VV"), 3)
    master = spark.createDataFrame([("s", dt.date(2025, 1, 1))], "stack_id string, master_day date")
    with pytest.raises(ValueError, match="absent master"):
        C.require_masters(C.stack_scenes(scenes, stack("VV")), master)


def days(n, step=12):
    return [dt.date(2023, 7, 5) + dt.timedelta(days=step * i) for i in range(n)]


def test_break_plan(spark):
    five = spark.createDataFrame([("a", d) for d in days(5)], "stack_id string, day date")
    assert S.plan_breaks(five).isEmpty()
    with pytest.raises(ValueError):
        S.require_breaks(S.plan_breaks(five))
    six = S.plan_breaks(spark.createDataFrame([("a", d) for d in days(6)], "stack_id string, day date")).collect()
    assert len(six) == 1 and (six[0].break_after, six[0].break_before) == (days(6)[2], days(6)[3])
    assert six[0].front_master == days(6)[1] and six[0].front_id == "a_cdpsi_front_20230705_20230729"


@pytest.mark.parametrize("seed", range(3))
def test_break_plan_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(k, dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(80))) for k in "ab" for _ in range(25)]
    got = {(r.stack_id, r.n_front): r for r in S.plan_breaks(spark.createDataFrame(rows, "stack_id string, day date"), 4).collect()}
    nearest = lambda side: min(side, key=lambda d: (abs(2 * (d - side[0]).days - (side[-1] - side[0]).days), d))
    for k in "ab":
        own = sorted(d for s, d in rows if s == k)
        for i in range(4, len(own) - 3):
            r = got.pop((k, i))
            assert (r.n_back, r.break_after, r.break_before, r.break_index) == (len(own) - i, own[i - 1], own[i], i - 3)
            assert (r.front_master, r.back_master) == (nearest(own[:i]), nearest(own[i:]))
            assert r.front_id == f"{k}_cdpsi_front_{own[0]:%Y%m%d}_{own[i - 1]:%Y%m%d}"
    assert not got


def psi_tables(spark):
    rows = []
    for i in range(45):
        tc = (0.82, 0.83, 0.81) if i < 40 else (0.20, 0.18, 0.95)
        for subset, v in zip((None, "f", "b"), tc, strict=True):
            rows.append(("a", subset, i, i // 9, i % 9, v + (i % 5) * 0.001 * (subset is not None), float(i * 5), 0.0))
    return spark.createDataFrame(rows, "stack_id string, subset_id string, point_id long, azimuth_index long, range_index long, temporal_coherence double, x double, y double")


def test_psi_pipeline(spark):
    breaks = spark.createDataFrame([("a", "f", "b", dt.date(2023, 9, 10), dt.date(2023, 9, 22))], "stack_id string, front_id string, back_id string, break_after date, break_before date")
    out = run_psi(psi_tables(spark), breaks)
    assert out["change"].count() == 45 and out["emergence"].count() == 5
    assert [r.point_count for r in out["polygons"].collect()] == [5]
    assert {r.confidence_class for r in out["points"].collect()} == {"medium"}
    with pytest.raises(ValueError, match="no points for subsets"):
        run_psi(psi_tables(spark).where("subset_id IS NULL OR subset_id <> 'b'"), breaks)
    with pytest.raises(ValueError, match="repeated pixel keys"):
        run_psi(psi_tables(spark).union(psi_tables(spark).limit(1)), breaks)


def test_threshold_of_constant_values_is_their_mean(spark):
    df = spark.createDataFrame([("g", 0.5)] * 6 + [("one", 0.5)], "g string, v double")
    got = S.sigma_threshold(df, "v", ["g"]).collect()
    assert [r.g for r in got] == ["g"] and got[0].sigma <= 0.03 and got[0].n == 6


def test_evidence_and_clusters(spark):
    pts = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 0.0), (3, 100.0, 0.0)], "point_id long, x double, y double")
    rects = spark.createDataFrame([(1, -1.0, -1.0, 8.0, 2.0, k) for k in ("amplitude_support", "optical_support", "optical_support")], "rect_id long, x0 double, y0 double, x1 double, y1 double, kind string")
    scored = X.confidence(X.evidence_flags(pts, rects))
    assert [(r.point_id, round(r.confidence_score, 6), r.confidence_class) for r in scored.orderBy("point_id").collect()] == [(1, 0.95, "high"), (2, 0.95, "high"), (3, 0.65, "medium")]
    assert sorted(r.point_count for r in X.cluster_stats(X.cluster_points(scored, 6.0)).collect()) == [1, 2]


def test_clusters_against_brute_force(spark):
    rnd = random.Random(3)
    pts = [(i, rnd.random() * 300, rnd.random() * 300) for i in range(250)]
    root = list(range(250))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x, y in pts:
        for j, u, v in pts[:i]:
            if (x - u) ** 2 + (y - v) ** 2 <= 20**2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r.point_id: r.cluster_id for r in X.cluster_points(spark.createDataFrame(pts, "point_id long, x double, y double"), 10.0).collect()}
    assert got == {i: find(i) for i in range(250)}


def test_crowded_neighbours_are_linked_without_their_pairs(spark):
    """Two cells of 20,000 points each: 4 x 10^8 pairs would take minutes."""
    rnd = random.Random(4)
    pts = [(i, rnd.random() * 14 + 14.2 * (i % 2), rnd.random() * 14) for i in range(40000)] + [(99999, 100.0, 100.0)]
    begun = time.time()
    got = X.cluster_points(spark.createDataFrame(pts, "point_id long, x double, y double"), 10.0).groupBy("cluster_id").count().collect()
    assert {r.cluster_id: r["count"] for r in got} == {0: 40000, 99999: 1} and time.time() - begun < 60


@pytest.mark.parametrize("apart,clusters", [(24.6, 2), (24.3, 1)])
def test_crowded_spots_about_a_step_apart(spark, apart, clusters, monkeypatch):
    """Two spots whose points lie within or just beyond a step of each other: refined, not compared in pairs."""
    seen, keep = {}, X.stage
    monkeypatch.setattr(X, "stage", lambda df, name: seen.setdefault(name, []).append(keep(df, name)) or seen[name][-1])
    compared = []
    for n in (4000, 16000):
        rnd = random.Random(6)
        pts = [(i, rnd.random() * 0.5 + apart * (i % 2), rnd.random() * 0.5) for i in range(2 * n)]
        seen.clear()
        got = X.cluster_points(spark.createDataFrame(pts, "point_id long, x double, y double"), 12.0).groupBy("cluster_id").count().collect()
        best = min(math.dist(p[1:], q[1:]) for p in sorted(pts[0::2], key=lambda p: -p[1])[:150] for q in sorted(pts[1::2], key=lambda p: p[1])[:150])
        assert len(got) == clusters == (1 if best <= 24 else 2)
        compared.append(sum(df.where("few").agg(F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0))).first()[0] for df in seen.get("cluster-both", [])))
    assert compared[1] <= 8 * max(compared[0], 50000) and compared[1] < 2e7  # all pairs would be 2.6 x 10^8


def test_point_and_polygon_evaluation(spark):
    pts = spark.createDataFrame([(0.0, 0.0), (50.0, 50.0)], "x double, y double")
    ref = spark.createDataFrame([(-1.0, -1.0, 1.0, 1.0)], "x0 double, y0 double, x1 double, y1 double")
    row = X.evaluate_points(pts, ref).first()
    assert (row.tp, row.fp, row.fn) == (1, 1, 0)
    a = spark.createDataFrame([(0.0, 0.0, 5.0, 5.0)], "x0 double, y0 double, x1 double, y1 double")
    b = spark.createDataFrame([(2.0, 2.0, 7.0, 7.0)], "x0 double, y0 double, x1 double, y1 double")
    assert X.evaluate_rects(a, b, 2.0).first().intersection_area == 9.0


def test_rectangles_of_all_sizes_against_brute_force(spark):
    rnd = random.Random(8)
    spots = [(rnd.randrange(-3000, 3000) * 1.0, rnd.randrange(-3000, 3000) * 1.0) for _ in range(300)]
    points = [(i, *p) for i, p in enumerate([*spots, *spots[:40], (None, 1.0), (0.0, float("nan"))])]
    boxes = [(0, -1e9, -1e9, 1e9, 1e9), (1, 5.0, 5.0, 5.0, 5.0), (2, None, 0.0, 9.0, 9.0)]
    for i in range(3, 60):
        x, y, side = rnd.randrange(-3000, 3000), rnd.randrange(-3000, 3000), 10 ** rnd.uniform(1, 3.7)
        boxes.append((i, float(x), float(y), x + side, y + side * rnd.uniform(0.1, 1)))
    p = spark.createDataFrame(points, "point_id int, x double, y double")
    r = spark.createDataFrame(boxes, "rect_id int, x0 double, y0 double, x1 double, y1 double")
    whole = [b for b in boxes if b[1] is not None]
    want = {(i, b[0]) for i, x, y in points if x is not None for b in whole if b[1] <= x <= b[3] and b[2] <= y <= b[4]}
    got = [(x.point_id, x.rect_id) for x in X.points_in_rects(p, r).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    few = r.where("rect_id > 20")
    e = X.evaluate_points(p, few).first()
    hits = [sum(k == i and b > 20 for k, b in want) for i, _, _ in points]
    assert (e.tp, e.fp) == (sum(hits), sum(h == 0 for h in hits))
    moved = [(b[0], b[1] + 70, b[2] + 30, b[3] + 70, b[4] + 30) for b in whole]
    m = spark.createDataFrame(moved, "rect_id int, x0 double, y0 double, x1 double, y1 double")
    common = sum(max(0, min(a[3], b[3]) - max(a[1], b[1])) * max(0, min(a[4], b[4]) - max(a[2], b[2])) for a in moved for b in whole)
    assert abs(X.evaluate_rects(m, spark.createDataFrame(whole, r.schema)).first().intersection_area / common - 1) < 1e-9


def test_ring_test_counts_borders(spark):
    ring = X.rect_ring(F.lit(0), F.lit(0), F.lit(5), F.lit(5))
    df = spark.createDataFrame([(2.0, 2.0), (5.0, 3.0), (0.0, 0.0), (5.1, 1.0)], "x double, y double")
    assert [r[0] for r in df.select(X.in_ring(F.col("x"), F.col("y"), ring)).collect()] == [True, True, True, False]


def test_centred_window(spark):
    scenes = spark.createDataFrame([("a", f"s{i}", dt.date(2024, 1, i)) for i in range(1, 8)], "stack_id string, scene_id string, day date")
    master = spark.createDataFrame([("a", dt.date(2024, 1, 4))], "stack_id string, master_day date")
    pick = lambda df: sorted(r.scene_id for r in df.collect())
    assert pick(C.centred_window(scenes, 5, 5, master)) == ["s2", "s3", "s4", "s5", "s6"]
    assert pick(C.centred_window(scenes, 5, 5)) == ["s1", "s2", "s3", "s4", "s5"]
    assert C.centred_window(scenes, 5, 8).isEmpty()


def test_paths_and_tokens(spark):
    links = ["s3://bucket/a/X.SAFE/manifest.safe", "s3://bucket/a/manifest.safe", "s3://bucket/a/b/", "https://x/y"]
    df = spark.createDataFrame([(x,) for x in links], "href string")
    assert [r[0] for r in df.select(C.object_path(F.col("href"))).collect()] == ["/bucket/a/X.SAFE", "/bucket/a", "/bucket/a/b", None]
    row = spark.range(1).select(C.normalize(F.lit("SENTINEL-1_A")), C.platform_id(F.lit("sentinel-1b")), C.product_uuid(F.lit("h/Products(12-ab)/$value"))).first()
    assert tuple(row) == ("sentinel1a", "S1B", "12-ab")


def test_band_audit_rejects_repeats(spark):
    names = ["i_VV_mst_22Sep2023", "q_VV_mst_22Sep2023", "i_VV_slv1_22Sep2023", "i_VV_slv2_04Oct2023", "junk"]
    df = spark.createDataFrame([Row(product_id="p", band_name=n) for n in names])
    got = sorted((r.problem, r.detail) for r in C.audit_bands(df).collect())
    assert got == [("duplicate", "i_VV_22Sep2023"), ("missing", "q_VV_04Oct2023"), ("unexpected", "junk")]


def test_utm(spark):
    df = spark.createDataFrame([(-7.75, 33.45), (9.0, 0.0), (10.0, 85.0), (10.0, -5.0)], "lon double, lat double")
    assert [r[0] for r in df.select(geo.metric_crs(F.col("lon"), F.col("lat"))).collect()] == ["EPSG:32629", "EPSG:32632", "EPSG:3857", "EPSG:32732"]
    e, n = geo.utm_forward(F.lit(9.0), F.lit(0.0), F.lit(32))
    row = spark.range(1).select(e, n).first()
    assert abs(row[0] - 500000) < 1e-6 and abs(row[1]) < 1e-6


def test_builtup_pipeline_on_a_small_grid(spark):
    cfg = BuiltUp(("p1",), 8, 8, tile=4)
    out = run_builtup(radar(spark, BLOCK), None, cfg)
    assert out["polygons"].count() >= 1 and out["report"].first().candidate_pixels == 9
    truth = out["cumulative"].select("r", "c", (F.col("first_change") > 0).alias("truth"))
    metrics = evaluate_builtup(truth.withColumnRenamed("truth", "predicted"), truth)["metrics"].first()
    assert metrics.iou == 1.0
    assert set(run_builtup(radar(spark, BLOCK), None, cfg, "composite")) == {"composite"}
    with pytest.raises(ValueError):
        run_builtup(radar(spark, BLOCK), None, BuiltUp(("p1",), 8, 8, allow_unavailable=False))
    with pytest.raises(ValueError):
        run_builtup(radar(spark, BLOCK).limit(0), None, cfg)


def test_builtup_pipeline_resumes_from_whole_artifacts(spark, tmp_path):
    cfg, store = BuiltUp(("p1",), 8, 8, tile=4), str(tmp_path / "run")
    first = run_builtup(radar(spark, BLOCK), None, cfg, store=store)
    area = first["polygons"].first().area_ha
    stamps = {p.parent.name: p.stat().st_mtime_ns for p in (tmp_path / "run").glob("*/_SUCCESS")}
    (tmp_path / "run" / "zones" / "_SUCCESS").unlink()  # a broken artifact is built again, the others are read
    again = run_builtup(radar(spark, set()), None, cfg, store=store)
    assert again["polygons"].first().area_ha == area
    now = {p.parent.name: p.stat().st_mtime_ns for p in (tmp_path / "run").glob("*/_SUCCESS")}
    assert {n for n in now if now[n] != stamps[n]} == {"zones"}
    # other settings: what depends on them is built again, and what was not is read
    run_builtup(radar(spark, BLOCK), None, BuiltUp(("p1",), 8, 8, tile=4, cleaning=Cleaning(least_pixels=5)), store=store)
    last = {p.parent.name: p.stat().st_mtime_ns for p in (tmp_path / "run").glob("*/_SUCCESS")}
    assert {n for n in last if last[n] == now[n]} == {"composite", "tested", "support"}


def _clipped(subject, clip):
    """Area of a convex polygon cut by another (both counterclockwise), half plane by half plane."""
    for (ax, ay), (bx, by) in zip(clip, [*clip[1:], clip[0]], strict=True):
        side = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for x, y in subject]
        cut = []
        for i, (x, y) in enumerate(subject):
            j = i - 1
            if side[i] * side[j] < 0:
                t = side[j] / (side[j] - side[i])
                cut.append((subject[j][0] + t * (x - subject[j][0]), subject[j][1] + t * (y - subject[j][1])))
            if side[i] >= 0:
                cut.append((x, y))
        subject = cut
        if not subject:
            return 0.0
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(subject, [*subject[1:], subject[0]], strict=True))) / 2


def test_overlap_of_concave_polygons_against_clipped_triangles(spark):
    rng = random.Random(5)
    rows, want = [], []

    def arrow():
        """A dart: two triangles on one axis, its ring clockwise or not, at the coordinates of a projected grid."""
        x, y, w, h = rng.randint(0, 30), rng.randint(0, 30), rng.randint(5, 30), rng.randint(5, 30)
        tip, low, notch, top = (x + w, y), (x - w, y - h), (x - w / 2, y), (x - w, y + h)
        ring = [tip, top, notch, low, tip]
        return (ring if rng.random() < 0.5 else ring[::-1]), [[tip, top, notch], [tip, notch, low]]

    for _ in range(60):
        (a, parts), (b, others) = arrow(), arrow()
        rows.append(tuple([[{"x": 500000.0 + x, "y": 3000000.0 + y} for x, y in ring]] for ring in (a, b)))
        want.append(sum(_clipped(p, q) for p in parts for q in others))
    kind = "array<array<struct<x: double, y: double>>>"
    got = [r.v for r in spark.createDataFrame(rows, f"a {kind}, b {kind}").select(X.overlap_area(F.col("a"), F.col("b")).alias("v")).collect()]
    assert sum(w > 0 for w in want) > 20
    assert all(abs(g - w) < 1e-6 for g, w in zip(got, want, strict=True))


def test_overlap_leaves_out_holes(spark):
    ring = lambda a, b: X.rect_ring(*[F.lit(float(v)) for v in (a, a, b, b)])
    shapes = spark.range(1).select(F.array(ring(0, 10), ring(2, 4)).alias("rings"))
    row = X.evaluate_polygons(shapes, spark.range(1).select(F.array(ring(3, 12)).alias("rings"))).first()
    assert (row.predicted_area, row.reference_area, row.intersection_area) == (96.0, 81.0, 48.0)
    none = X.evaluate_polygons(shapes.limit(0), shapes.limit(0)).first()
    assert (none.intersection_area, none.iou) == (0.0, None)


def test_truth_on_a_wider_grid_is_aligned(spark):
    predicted = spark.createDataFrame([(r, c, r < 2) for r in range(4) for c in range(4)], "r int, c int, predicted boolean")
    truth = spark.createDataFrame([(0, 0, True), (5, 5, True)], "r int, c int, truth boolean")
    row = evaluate_builtup(predicted, truth, scale=0.5)["metrics"].first()
    assert (row.tp, row.fp, row.fn, row.tn) == (4, 4, 0, 8)


def test_a_mean_at_a_bound_is_of_the_upper_class(spark):
    """Doubles add up to less or more by their order: clusters whose mean is 0.7 or 0.45 by decimals, in several orders."""
    rows = []
    for k, (scores, many) in enumerate([((0.65, 0.65, 0.65, 0.65 + 0.2), n) for n in range(1, 13)] + [((0.65, 0.25), n) for n in range(1, 13)]):
        rows += [(2 * k, s) for s in [*scores] * many] + [(2 * k + 1, s) for s in sorted([*scores] * many)]
    df = spark.createDataFrame(rows, "cluster_id long, confidence_score double").select("*", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    got = {r.cluster_id: (r.confidence_class, r.mean_confidence) for r in X.cluster_stats(df).collect()}
    assert got == {k: ("high", 0.7) if k < 24 else ("medium", 0.45) for k in range(48)}
