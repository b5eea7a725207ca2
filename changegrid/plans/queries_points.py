"""Registered point, catalogue, projection and evaluation queries and their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changegrid.config import Psi
from changegrid.functions import geo
from changegrid.operators import bands as N
from changegrid.operators import catalog as C
from changegrid.operators import discs as D
from changegrid.operators import polygons as G
from changegrid.operators import psi as S
from changegrid.operators import raster as R
from changegrid.operators import spatial as X
from changegrid.plans.fixtures import duckdb, view
from changegrid.plans.pipelines import run_psi
from changegrid.plans.queries_raster import rounded
from changegrid.sources import io
from changegrid.sources.staging import shared_dir

WINDOWS = "SELECT * FROM (VALUES ('p1', 'before', DATE '1995-06-01', DATE '1995-09-30'), ('p1', 'after', DATE '1999-06-01', DATE '1999-09-30'), ('p2', 'before', DATE '1996-06-01', DATE '1996-09-30'), ('p2', 'after', DATE '2000-06-01', DATE '2000-09-30')) AS w(period_id, phase, start, end_day)"
#: Stacks: orbit direction, number and the day near which their master lies.
STACKS = "SELECT * FROM (VALUES ('asc0', 'ascending', 0, 'VV'), ('desc1', 'descending', 1, 'VH'), ('asc4', 'ascending', 4, 'VV+VH')) AS s(stack_id, direction, relative_orbit, polarization)"


#: Areas of interest: boxes in degrees.
AREAS = "SELECT * FROM (VALUES (CAST(-7.8 AS DOUBLE), CAST(33.4 AS DOUBLE), CAST(-6.7 AS DOUBLE), CAST(33.5 AS DOUBLE)), (CAST(100 AS DOUBLE), CAST(-20 AS DOUBLE), CAST(131 AS DOUBLE), CAST(4 AS DOUBLE)), (CAST(110 AS DOUBLE), CAST(0 AS DOUBLE), CAST(120 AS DOUBLE), CAST(9 AS DOUBLE))) AS a(x0, y0, x1, y1)"


#: An area of interest of two parts: an L, whose box meets more than it does, and a frame (a square with a hole).
AREA_RINGS = (((100, -20), (131, -20), (131, -12), (108, -12), (108, 4), (100, 4)),), (((-60, 10), (-20, 10), (-20, 50), (-60, 50)), ((-55, 15), (-55, 45), (-25, 45), (-25, 15)))


def area_rings(spark) -> DataFrame:
    closed = [([[(float(x), float(y)) for x, y in (*ring, ring[0])] for ring in shape],) for shape in AREA_RINGS]
    return spark.createDataFrame(closed, "rings array<array<struct<x: double, y: double>>>")


def windows(spark):
    return spark.sql(WINDOWS).withColumnRenamed("end_day", "end")


def stacked(spark, d) -> DataFrame:
    return C.stack_scenes(view(spark, d, "scenes"), spark.sql(STACKS)).select("stack_id", "scene_id", "day")


def masters(spark, d):
    """For each stack the day of its scene 100 days after its first or next."""
    s = stacked(spark, d)
    first = s.groupBy("stack_id").agg(F.min("day").alias("first"))
    later = s.join(first, "stack_id").where(F.col("day") >= F.date_add("first", 100))
    return later.groupBy("stack_id").agg(F.min("day").alias("master_day"))


def monthly(spark, d) -> DataFrame:
    """One scene a quarter of each stack: the first."""
    s = stacked(spark, d)
    return s.groupBy("stack_id", F.date_trunc("quarter", "day").alias("q")).agg(F.min("day").alias("day")).select("stack_id", "day")


def orbit_files(spark, d) -> DataFrame:
    """A monthly sequence of validities over the scenes' years, two days of overlap, and some resorb files."""
    days = view(spark, d, "scenes").select(F.year("day").alias("y"), F.month("day").alias("m")).distinct()
    start = F.make_date("y", "m", F.lit(1))
    stamp = lambda c: F.concat(F.date_format(c, "yyyyMMdd"), F.lit("T000000"))
    kind = F.explode(F.array(F.lit("POEORB"), F.lit("RESORB"))).alias("kind")
    rows = days.select(start.alias("start"), F.date_add(F.last_day(start), 2).alias("stop"), F.explode(F.array(F.lit("S1A"), F.lit("S1B"))).alias("platform")).select("*", kind)
    return rows.select(F.concat(F.col("platform"), F.lit("_OPER_AUX_"), F.col("kind"), F.lit("_OPOD_"), stamp(F.col("stop")), F.lit("_V"), stamp(F.col("start")), F.lit("_"), stamp(F.col("stop")), F.lit(".EOF")).alias("name"))


def bands(spark, d) -> DataFrame:
    """Band names of products: one a stack and year, an i and q band a scene, some of them defective."""
    s = view(spark, d, "scenes").select(F.concat_ws("_", "direction", F.col("relative_orbit").cast("string"), F.year("day").cast("string")).alias("product_id"), "day", "k")
    token = F.date_format("day", "ddMMMyyyy")
    part = F.explode(F.array(F.lit("i"), F.lit("q"))).alias("component")
    s = s.select("product_id", "k", token.alias("token"), part).where("NOT (k % 50 = 7 AND component = 'q')")
    name = F.concat(F.col("component"), F.lit("_VV_slv1_"), F.col("token"))
    return s.select("product_id", F.when(F.col("k") % 50 == 3, F.concat(F.lit("bad_"), name)).otherwise(name).alias("band_name"))


def band_dates(spark, d) -> DataFrame:
    return view(spark, d, "band_days").select("product_id", "token", (F.col("n") == 0).alias("master"))


#: Breaks of the derived point tables.
BREAKS = ("2023-09-10", "2023-10-04", "2023-09-22")


def classified(spark, d) -> DataFrame:
    p = view(spark, d, "psi_points")
    role = lambda c: p.select("point_id", *S.KEY, F.col(c).alias("temporal_coherence"))
    m = S.change_indices(S.match_points(role("tc_c"), role("tc_f"), role("tc_b")))
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("b"), F.lit(day).alias("break_after")) for i, day in enumerate(BREAKS)]))
    m = m.select("*", at.alias("at")).select("*", "at.*").withColumns({"stack_id": F.lit("asc0"), "break_before": F.lit("2023-10-16")})
    # the second break's values are a fifth weaker on odd rows, the third's equal the first's, so ties fall to dates
    m = m.withColumn("ci_emergence", F.when((F.col("b") == 1) & (F.col("azimuth_index") % 2 == 1), F.col("ci_emergence") * 0.8).when(F.col("b") == 1, F.col("ci_emergence") * 1.25).otherwise(F.col("ci_emergence")))
    return S.classify(m, ["stack_id", "break_after"], 1.0)


def indices(spark, d):
    p = view(spark, d, "psi_points")
    role = lambda c: p.select("point_id", *S.KEY, F.col(c).alias("temporal_coherence"))
    return S.change_indices(S.match_points(role("tc_c"), role("tc_f"), role("tc_b")))


def kinds_of_rects(spark, d):
    kind = F.element_at(F.array(*[F.lit(k) for k in ("amplitude_support", "optical_support", "optical_reliable", "context_support")]), (F.col("rect_id") % 4 + 1).cast("int"))
    return view(spark, d, "rects").withColumn("kind", kind)


def evidence(spark, d):
    return X.evidence_flags(view(spark, d, "points_xy"), kinds_of_rects(spark, d))


def moved_rects(spark, d):
    return view(spark, d, "rects").select((F.col("x0") + 100).alias("x0"), (F.col("y0") + 50).alias("y0"), (F.col("x1") + 100).alias("x1"), (F.col("y1") + 50).alias("y1"))


def diamonds(spark, d, moved: int = 0, hole: bool = False) -> DataFrame:
    """``(rect_id, rings)``: a square on its corner about each rectangle's middle, perhaps with one of half its size cut out."""
    r = view(spark, d, "rects").select("rect_id", ((F.col("x0") + F.col("x1")) / 2 + moved).alias("mx"), ((F.col("y0") + F.col("y1")) / 2 + moved).alias("my"), (F.lit(200.0) + 20 * (F.col("rect_id") % 7)).alias("h"))
    corner = lambda dx, dy: F.struct((F.col("mx") + dx).alias("x"), (F.col("my") + dy).alias("y"))
    ring = lambda h: F.array(corner(-h, F.lit(0.0)), corner(F.lit(0.0), -h), corner(h, F.lit(0.0)), corner(F.lit(0.0), h), corner(-h, F.lit(0.0)))
    return r.select("rect_id", F.array(ring(F.col("h")), *([ring(F.col("h") / 2)] if hole else [])).alias("rings"))


def kinds_of_diamonds(spark, d):
    """Diamonds with holes as evidence of one kind each."""
    kind = F.element_at(F.array(*[F.lit(k) for k in ("amplitude_support", "optical_support", "optical_reliable", "context_support")]), (F.col("rect_id") % 4 + 1).cast("int"))
    return diamonds(spark, d, hole=True).withColumn("kind", kind)


def pair_overlaps(spark, d):
    """What each diamond with a hole shares with the whole one it was moved from."""
    both = diamonds(spark, d, 70, True).withColumnRenamed("rings", "prings").join(diamonds(spark, d).withColumnRenamed("rings", "qrings"), "rect_id")
    return G.shared_areas(both, ["rect_id"])


def dissolved(spark, d):
    """Rectangles and moved rectangles as one shape: all its rings' areas, signed, and their number of parts and holes is the shape's own."""
    ring = X.rect_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])
    sides = ["x0", "y0", "x1", "y1"]
    return G.dissolve(view(spark, d, "rects").select(*sides).unionByName(moved_rects(spark, d)).select(F.array(ring).alias("rings")))


def gain() -> Column:
    """Factor of the emergence index: that of the second break differs by line."""
    return F.when(F.col("break_after") != BREAKS[1], 1.0).when(F.col("azimuth_index") % 2 == 1, 0.8).otherwise(1.25)


def fused_points(spark, d) -> DataFrame:
    """The point pipeline over one stack and three breaks, whose tables differ as those of ``classified``: by the steps of the SQL, so bins fall alike."""
    p = view(spark, d, "psi_points")
    held = [(F.lit(None).cast("string"), F.col("tc_c"))]
    by = [F.when(F.col("azimuth_index") % 2 == 1, 0.8).otherwise(1.25) if b == 1 else F.lit(1.0) for b in range(len(BREAKS))]
    held += [(F.lit(f"front{b}"), F.col("tc_f")) for b in range(len(BREAKS))] + [(F.lit(f"back{b}"), F.col("tc_c") + (F.col("tc_b") - F.col("tc_c")) * by[b]) for b in range(len(BREAKS))]
    each = F.explode(F.array(*[F.struct(name.alias("subset_id"), tc.alias("temporal_coherence")) for name, tc in held])).alias("e")
    points = p.select(F.lit("asc0").alias("stack_id"), "point_id", *S.KEY, (F.col("range_index") * 20.0).alias("x"), (F.col("azimuth_index") * 20.0).alias("y"), each).select("*", "e.*").drop("e")
    breaks = spark.createDataFrame([("asc0", f"front{b}", f"back{b}", day, "2023-10-16") for b, day in enumerate(BREAKS)], "stack_id string, front_id string, back_id string, break_after string, break_before string")
    return run_psi(points, breaks, kinds_of_rects(spark, d), Psi(sigma_multiplier=1.0, cluster_buffer_m=10.0), outlines=False)["points"]


#: Stacks over one ground: id, factor of the emergence index, what is added to it on some pixels, the pixels seen, shift of x.
#: All have the same pixel keys and point ids, which mean other scatterers in each.
LOOKS = (("asc0", 1.0, "0", "true", 0), ("desc1", 0.9, "CASE WHEN (azimuth_index + 2 * range_index) % 31 = 0 THEN CAST(0.5 AS DOUBLE) ELSE 0 END", "true", 3), ("asc4", 1.1, "0", "range_index % 2 = 0", 5))


def looked(spark, d) -> DataFrame:
    """``psi_points`` as each stack sees them: ``stack_id``, ``shift`` and the stack's own ``tc_b``."""
    p, out = view(spark, d, "psi_points"), None
    for name, factor, more, seen, shift in LOOKS:
        tc_b = F.col("tc_c") + (F.col("tc_b") - F.col("tc_c")) * factor + F.expr(more)
        part = p.where(seen).select("point_id", *S.KEY, "tc_c", "tc_f", tc_b.alias("tc_b"), F.lit(name).alias("stack_id"), F.lit(shift).alias("shift"))
        out = part if out is None else out.unionByName(part)
    return out


def fused_stacks(spark, d) -> dict[str, DataFrame]:
    """The point pipeline over all stacks at once, each with its own breaks and subsets."""
    points, plan = looked(spark, d), []
    held = [(F.lit(None).cast("string"), F.col("tc_c"))]
    for b in range(len(BREAKS)):
        held += [(F.concat("stack_id", F.lit(f"/front{b}")), F.col("tc_f")), (F.concat("stack_id", F.lit(f"/back{b}")), F.col("tc_b"))]
        plan += [(name, f"{name}/front{b}", f"{name}/back{b}", BREAKS[b], "2023-10-16") for name, *_ in LOOKS]
    each = F.explode(F.array(*[F.struct(name.alias("subset_id"), tc.alias("temporal_coherence")) for name, tc in held])).alias("e")
    points = points.select("stack_id", "point_id", *S.KEY, (F.col("range_index") * 20.0 + F.col("shift")).alias("x"), (F.col("azimuth_index") * 20.0).alias("y"), each).select("*", "e.*").drop("e")
    breaks = spark.createDataFrame(plan, "stack_id string, front_id string, back_id string, break_after string, break_before string")
    return run_psi(points, breaks, kinds_of_rects(spark, d), Psi(sigma_multiplier=1.0, cluster_buffer_m=10.0), outlines=False, gain=gain())


def lonlat(spark, d):
    """Points dealt over the globe, from the events."""
    p = view(spark, d, "points_xy")
    return p.select("point_id", (F.col("x") / 10000.0 * 359 - 179.5).alias("lon"), (F.col("y") / 10000.0 * 178 - 89).alias("lat"))


def projected(spark, d):
    p = lonlat(spark, d).where("lat > -80 AND lat < 84").withColumn("zone", geo.utm_zone(F.col("lon")))
    e, n = geo.utm_forward(F.col("lon"), F.col("lat"), F.col("zone"))
    return p.select("point_id", "zone", e.alias("easting"), n.alias("northing"))


#: Tables of points, each in one system: north over the equator, south over it, and near the pole.
TABLES = (("north", "EPSG:32631", -2.0, 8.0, -3.0, 70.0), ("south", "EPSG:32719", -76.0, 12.0, -62.0, 70.0), ("polar", "EPSG:3857", -170.0, 300.0, 84.0, 5.0))


def in_tables(spark, d) -> DataFrame:
    """The points dealt to three tables, each projected by the system of its middle and back again."""
    p, out = view(spark, d, "points_xy"), None
    for k, (name, _, lon0, wide, lat0, high) in enumerate(TABLES):
        own = p.where(F.col("point_id") % 3 == k).select("point_id", (F.col("x") / 10000.0 * wide + lon0).alias("lon"), (F.col("y") / 10000.0 * high + lat0).alias("lat"))
        crs = io.table_crs(own)
        x, y = geo.forward(crs, F.col("lon"), F.col("lat"))
        placed = own.select("point_id", F.lit(name).alias("name"), F.lit(crs).alias("crs"), "lon", "lat", x.alias("x"), y.alias("y"))
        lon, lat = geo.inverse(crs, F.col("x"), F.col("y"))
        part = placed.select("point_id", "name", "crs", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"))
        out = part if out is None else out.unionByName(part)
    return out


def windowed(spark, d) -> DataFrame:
    """Scenes of both sensors by the windows that hold them: radar by platform and polarisation, optical by cloud cover."""
    s, w = view(spark, d, "scenes"), windows(spark)
    own = lambda df, sensor: C.in_windows(df, w).select("period_id", "phase", F.lit(sensor).alias("sensor"), "scene_id")
    return own(C.filter_radar(s, "Sentinel-1A", "ascending", ("vv",), mode="IW"), "s1").unionByName(own(C.filter_optical(s, 30.0), "s2"))


def located(spark, d) -> DataFrame:
    """Object paths of scenes whose links stand in different assets, and are filled in from a table where there is none."""
    k, link = F.col("k"), lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    href = "struct<href: string, alternate: map<string, struct<href: string>>>"
    none = F.create_map().cast("map<string, struct<href: string>>")
    web = F.struct(link("https://host/", F.col("scene_id")).alias("href"), none.alias("alternate")).cast(href)
    own = F.struct(link("s3://bucket/own/", F.col("scene_id"), ".SAFE/measurement/vv.tiff").alias("href"), none.alias("alternate")).cast(href)
    other = F.struct(link("https://host/", F.col("scene_id")).alias("href"), F.create_map(F.lit("s3+https"), F.struct(link("s3://bucket/alt/", F.col("scene_id"), "/Manifest.safe").alias("href"))).alias("alternate")).cast(href)
    assets = F.when(k % 4 == 0, F.create_map(F.lit("vv"), own, F.lit("product"), web)).when(k % 4 == 1, F.create_map(F.lit("product"), other, F.lit("vv"), own)).otherwise(F.create_map(F.lit("product"), web))
    name = F.when(k % 4 == 2, link("S1A_IW_SLC__", F.col("scene_id"))).otherwise(F.col("scene_id"))
    s = view(spark, d, "scenes").select("scene_id", "k", "day", assets.alias("assets"), name.alias("name"))
    held = s.select("scene_id", "k", C.scene_path(F.col("assets"), ("product",), F.col("name"), F.col("day")).alias("s3_path"))
    more = s.where("k % 8 = 3 OR k % 8 = 0").select("scene_id", link("/later/", F.col("scene_id")).alias("s3_path"))
    return io.backfill_paths(held, more).select("scene_id", "s3_path")


def described(spark, d) -> DataFrame:
    found = S.describe_plan(stacked(spark, d), S.plan_breaks(stacked(spark, d)))
    names = F.array_join(F.transform("break_intervals", lambda b: F.concat_ws("/", b.break_after.cast("string"), b.front_id)), ",")
    return found.select("stack_id", "scene_count", "minimum_subset_images", "valid_break_count", "subset_run_count", "valid", F.sha2(names, 256).alias("intervals"))


def exported(spark, d) -> DataFrame:
    """What readers find in each file of an export, and in the run's summary."""
    path = f"{shared_dir(spark)}/exports/{uuid.uuid4().hex}"
    points, polygons = view(spark, d, "points_xy").where("point_id % 10 = 0"), diamonds(spark, d, hole=True)
    io.export_fusion(points, polygons, path, intermediate=True)
    io.write_run_summary(points, polygons, "run", ["asc0", "desc1"], f"{path}/summary")
    out = spark.read.json(f"{path}/summary").select(F.lit("summary").alias("file"), F.col("candidate_points").alias("n"), F.col("candidate_polygons").cast("double").alias("total"))
    for suffix in ("parquet", "geojson"):
        p, q = (io.read_vector(spark, f"{path}/{name}.{suffix}") for name in ("cdpsi_emergence_candidates", "fused_change_candidates"))
        out = out.unionByName(p.agg(F.count("*").alias("n"), F.sum(F.col("rings")[0][0]["x"]).alias("total")).withColumn("file", F.lit(f"points.{suffix}")))
        out = out.unionByName(q.agg(F.count("*").alias("n"), F.sum(X.polygon_area(F.col("rings"))).alias("total")).withColumn("file", F.lit(f"polygons.{suffix}")))
    return out


def paths(spark, d):
    s = view(spark, d, "scenes").select("k", "scene_id", F.concat(F.lit("s3://bucket/a/"), F.col("scene_id"), F.when(F.col("k") % 2 == 0, ".SAFE/manifest.safe").otherwise("/manifest.safe")).alias("href"), F.concat(F.lit("https://host/Products("), F.col("k").cast("string"), F.lit("-ab)/$value")).alias("link"))
    return s.select("scene_id", C.object_path(F.col("href")).alias("path"), C.product_uuid(F.col("link")).alias("uuid"))


QUERIES = {
    "scene_filter_s1": lambda s, d: C.filter_radar(view(s, d, "scenes"), "Sentinel-1A", "ascending", ("vv", "V-H"), mode="IW").select("scene_id", "day"),
    "scene_filter_s2": lambda s, d: rounded(C.filter_optical(view(s, d, "scenes"), 30.0).select("scene_id", "cloud_cover")),
    "scene_areas": lambda s, d: C.filter_optical(view(s, d, "scenes"), 50.0, areas=s.sql(AREAS)).select("scene_id"),
    "scene_windows": lambda s, d: C.in_windows(view(s, d, "scenes"), windows(s)).select("period_id", "phase", "scene_id", "day"),
    "stack_scenes": lambda s, d: stacked(s, d),
    "stack_summary": lambda s, d: C.stack_summary(stacked(s, d)),
    "master_centred_window": lambda s, d: C.centred_window(stacked(s, d), 24, 5, masters(s, d)),
    "master_secondaries": lambda s, d: C.secondaries(stacked(s, d), masters(s, d)).select("stack_id", "scene_id", "day"),
    "stack_probe": lambda s, d: C.probe_stacks(view(s, d, "scenes"), s.sql(STACKS)),
    "missing_dates": lambda s, d: C.missing_dates(stacked(s, d), monthly(s, d)),
    "date_chunks": lambda s, d: C.date_chunks(stacked(s, d).groupBy("stack_id").agg(F.min("day").alias("start"), F.max("day").alias("end"))).select("stack_id", "chunk_start", "chunk_end"),
    "orbit_match": lambda s, d: C.match_orbits(view(s, d, "scenes").select("scene_id", "day", "platform"), C.parse_orbit_files(orbit_files(s, d))).select("scene_id", "orbit_file"),
    "band_audit": lambda s, d: C.audit_bands(bands(s, d)),
    "band_select": lambda s, d: C.select_bands(bands(s, d)),
    "coreg_audit": lambda s, d: N.audit_coreg(view(s, d, "coreg_bands").select("product_id", "band_name", "position"), band_dates(s, d)),
    "ifg_audit": lambda s, d: N.audit_ifg(view(s, d, "ifg_bands").select("product_id", "band_name", "position"), band_dates(s, d)),
    "final_bands": lambda s, d: N.select_final(view(s, d, "coreg_bands").select("product_id", "band_name", "position"), band_dates(s, d)),
    "final_names": lambda s, d: N.parse_names(view(s, d, "ifg_bands").select("product_id", "band_name")).select("product_id", "band_name", "form", N.final_name().alias("final_name")),
    "export_bands": lambda s, d: N.select_export(view(s, d, "ifg_bands").select("product_id", "band_name"), "ifg"),
    "stack_inputs": lambda s, d: N.select_export(view(s, d, "coreg_bands").select("product_id", "band_name"), "coreg", stack_input=True),
    "pair_pivot": lambda s, d: C.pair_pivot(view(s, d, "scenes").select("day", F.concat(F.lit("IW"), (F.col("k") % 3 + 1).cast("string")).alias("swath"), F.col("scene_id").alias("product")), ["IW1", "IW2", "IW3"]),
    "item_counts": lambda s, d: rounded(R.item_counts(windowed(s, d), windows(s))),
    "scene_paths": located,
    "plan_describe": lambda s, d: rounded(described(s, d)),
    "fusion_export": lambda s, d: rounded(exported(s, d)),
    "path_derive": lambda s, d: paths(s, d),
    "cdpsi_breaks": lambda s, d: S.plan_breaks(stacked(s, d)).select("stack_id", "break_index", F.col("n_front").cast("int").alias("n_front"), F.col("n_back").cast("int").alias("n_back"), "break_after", "break_before", "front_id", "back_id"),
    "subset_master": lambda s, d: S.plan_breaks(stacked(s, d)).select("stack_id", "break_index", "front_master", "back_master"),
    "duplicate_keys": lambda s, d: rounded(S.duplicate_keys(view(s, d, "raw").select(F.col("r").alias("azimuth_index"), F.col("c").alias("range_index")))),
    "pixel_match": lambda s, d: rounded(indices(s, d).select(*S.KEY, "tc_complete", "tc_front", "tc_back", "front_point_id", "back_point_id")),
    "change_indices": lambda s, d: rounded(indices(s, d).select(*S.KEY, "ci_vanishment", "ci_emergence")),
    "mode_bin": lambda s, d: rounded(S.central_mode(indices(s, d).withColumn("g", F.col("azimuth_index") % 2), "ci_emergence", ["g"]).select("g", "n", "bins", "mode")),
    "sigma_threshold": lambda s, d: rounded(S.sigma_threshold(indices(s, d).withColumn("g", F.col("azimuth_index") % 2), "ci_emergence", ["g"], 3.0)),
    "cdpsi_classes": lambda s, d: rounded(classified(s, d).select(*S.KEY, "break_after", "cdpsi_class")),
    "emergence_points": lambda s, d: rounded(S.emergence_points(classified(s, d)).select(*S.KEY, "ci_emergence", "break_after")),
    "evidence_flags": lambda s, d: evidence(s, d).select("point_id", "amplitude_support", "optical_support", "optical_reliable", "context_support"),
    "evidence_polygons": lambda s, d: X.evidence_flags(view(s, d, "points_xy"), kinds_of_diamonds(s, d)).select("point_id", "amplitude_support", "optical_support", "optical_reliable", "context_support"),
    "polygon_hits": lambda s, d: rounded(X.evaluate_points(view(s, d, "points_xy"), diamonds(s, d, hole=True))),
    "pair_overlaps": lambda s, d: rounded(pair_overlaps(s, d)),
    "dissolved_area": lambda s, d: rounded(dissolved(s, d).select("area"), 3),
    "scene_shapes": lambda s, d: C.filter_optical(view(s, d, "scenes"), 50.0, areas=area_rings(s)).select("scene_id"),
    "confidence": lambda s, d: rounded(X.confidence(evidence(s, d)).select("point_id", "confidence_score", "confidence_class")),
    "point_clusters": lambda s, d: X.cluster_points(view(s, d, "points_xy"), 12.0).select("point_id", "cluster_id"),
    "cluster_outlines": lambda s, d: rounded(D.disc_unions(X.cluster_points(view(s, d, "points_xy"), 12.0), 12.0, ["cluster_id"]).select("cluster_id", "area", "perimeter"), 3),
    "cluster_stats": lambda s, d: rounded(X.cluster_stats(X.cluster_points(X.confidence(evidence(s, d)), 12.0)).select("cluster_id", "point_count", "mean_confidence", "confidence_class")),
    "parcel_summary": lambda s, d: X.parcel_summary(view(s, d, "points_xy"), view(s, d, "rects")).select("rect_id", "point_count"),
    "point_evaluation": lambda s, d: rounded(X.evaluate_points(view(s, d, "points_xy"), view(s, d, "rects"))),
    "polygon_evaluation": lambda s, d: rounded(X.evaluate_rects(moved_rects(s, d), view(s, d, "rects"))),
    "polygon_overlap": lambda s, d: rounded(X.evaluate_polygons(diamonds(s, d, 70, True), diamonds(s, d))),
    "points_in_polygons": lambda s, d: X.points_in_rings(view(s, d, "points_xy"), diamonds(s, d).select("rect_id", F.col("rings")[0].alias("ring"))).select("point_id", "rect_id"),
    "psi_pipeline": lambda s, d: rounded(fused_points(s, d).select("key", "break_after", "confidence_score", "confidence_class", "cluster_id")),
    "stacks_emergence": lambda s, d: rounded(fused_stacks(s, d)["emergence"].select("stack_id", *S.KEY, "ci_emergence", "break_after")),
    "stacks_pipeline": lambda s, d: rounded(fused_stacks(s, d)["points"].select("key", "break_after", "confidence_score", "confidence_class", "cluster_id")),
    "ring_measures": lambda s, d: rounded(view(s, d, "rects").select("rect_id", X.ring_area(ring := X.rect_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])).alias("area"), X.ring_length(ring).alias("length"))),
    "points_in_rings": lambda s, d: X.points_in_rings(view(s, d, "points_xy"), view(s, d, "rects").select("rect_id", X.rect_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("ring"))).select("point_id", "rect_id"),
    "utm_zone": lambda s, d: rounded(lonlat(s, d).select("point_id", geo.utm_zone(F.col("lon")).alias("zone"), geo.metric_crs(F.col("lon"), F.col("lat")).alias("crs"))),
    "utm_project": lambda s, d: rounded(projected(s, d), 3),
    "table_projection": in_tables,
    "snap_centers": lambda s, d: rounded(view(s, d, "rects").select("rect_id", *[v.alias(k) for k, v in geo.snap_bounds(F.col("x0") + 3, F.col("y0") + 7, F.col("x1"), F.col("y1"), 30.0, "center").items()])),
    "snap_bounds": lambda s, d: rounded(view(s, d, "rects").select("rect_id", *[v.alias(k) for k, v in geo.snap_bounds(F.col("x0") + 3, F.col("y0") + 7, F.col("x1"), F.col("y1"), 30.0).items()])),
}

_STACK = f""", st AS ({STACKS}), stk AS (SELECT stack_id, scene_id, day FROM scenes JOIN st USING (direction, relative_orbit) WHERE mode = 'IW' AND (level IS NULL OR level = 'L1') AND (product_type IS NULL OR product_type LIKE '%SLC%')
  AND CASE st.polarization WHEN 'VV' THEN scenes.polarization IN ('VV', 'VV+VH', 'VH+VV') WHEN 'VH' THEN scenes.polarization IN ('VV+VH', 'VH+VV') ELSE true END)
, mst AS (SELECT stack_id, min(day) AS master_day FROM stk JOIN (SELECT stack_id, min(day) AS f FROM stk GROUP BY 1) USING (stack_id) WHERE day >= f + 100 GROUP BY 1)
, mon AS (SELECT stack_id, min(day) AS day FROM stk GROUP BY stack_id, date_trunc('quarter', day))"""
_PLAN = _STACK + """, ord AS (SELECT *, row_number() OVER (PARTITION BY stack_id ORDER BY day) AS i, count(*) OVER (PARTITION BY stack_id) AS n FROM stk)
, cut AS (SELECT DISTINCT stack_id, n, unnest(range(3, n - 2)) AS k FROM ord WHERE n >= 6)
, plan0 AS (SELECT cut.stack_id, k, cut.n - k AS nb, min(day) FILTER (i <= k) AS f0, max(day) FILTER (i <= k) AS f1, min(day) FILTER (i > k) AS b0, max(day) FILTER (i > k) AS b1 FROM cut JOIN ord ON ord.stack_id = cut.stack_id GROUP BY cut.stack_id, k, cut.n)"""
_ORBIT = """, mo AS (SELECT DISTINCT CAST(date_trunc('month', day) AS DATE) AS a FROM scenes), fil AS (SELECT p || '_OPER_AUX_POEORB_OPOD_' || strftime(e, '%Y%m%d') || 'T000000_V' || strftime(a, '%Y%m%d') || 'T000000_' || strftime(e, '%Y%m%d') || 'T000000.EOF' AS name, p, a, e
  FROM (SELECT a, last_day(a) + 2 AS e FROM mo), (VALUES ('S1A'), ('S1B')) v(p))"""
_BAND = """, bnd AS (SELECT direction || '_' || CAST(relative_orbit AS VARCHAR) || '_' || CAST(year(day) AS VARCHAR) AS product_id, k, c, strftime(day, '%d%b%Y') AS token FROM scenes, (VALUES ('i'), ('q')) v(c) WHERE NOT (k % 50 = 7 AND c = 'q'))
, nam AS (SELECT product_id, token, c, k, CASE WHEN k % 50 = 3 THEN 'bad_' ELSE '' END || c || '_VV_slv1_' || token AS band_name FROM bnd)"""
_CI = """, ci AS (SELECT *, tc_f - tc_c AS van, tc_b - tc_c AS emg, azimuth_index % 2 AS g FROM psi_points)"""


def _fit(value: str, p: str) -> str:
    """Mode and refitted threshold of ``value`` by g: definitions whose names end in ``p``."""
    return f""", sp{p} AS (SELECT g, count(*) AS n, min({value}) AS lo, max({value}) AS hi, CAST(greatest(20, floor(sqrt(count(*)))) AS INT) AS bins FROM ci GROUP BY g)
, bn{p} AS (SELECT ci.g, least(CAST(floor(({value} - lo) / (hi - lo) * bins) AS INT), bins - 1) AS b, count(*) AS k FROM ci JOIN sp{p} ON sp{p}.g = ci.g GROUP BY 1, 2)
, md{p} AS (SELECT sp{p}.g, n, bins, lo + (arg_max(b, k * 100000 - b) + 0.5) * (hi - lo) / bins AS mode FROM bn{p} JOIN sp{p} USING (g) GROUP BY sp{p}.g, n, bins, lo, hi)
, mi{p} AS (SELECT ci.g, {value} AS x FROM ci JOIN md{p} ON md{p}.g = ci.g WHERE {value} <= mode UNION ALL SELECT ci.g, 2 * mode - {value} FROM ci JOIN md{p} ON md{p}.g = ci.g WHERE {value} < mode)
, m1{p} AS (SELECT g, avg(x) AS m1, stddev_pop(x) AS s1 FROM mi{p} GROUP BY g)
, ft{p} AS (SELECT g, avg(x) AS mu, stddev_pop(x) AS sg FROM mi{p} JOIN m1{p} USING (g) WHERE abs(x - m1) <= 3 * s1 GROUP BY g)"""


_CI3 = """, ci AS (SELECT p.azimuth_index, p.range_index, p.tc_f - p.tc_c AS van, brk.break_after, brk.b AS g,
  (p.tc_b - p.tc_c) * CASE WHEN brk.b = 1 AND p.azimuth_index % 2 = 1 THEN 0.8::DOUBLE WHEN brk.b = 1 THEN 1.25::DOUBLE ELSE 1::DOUBLE END AS emg
  FROM psi_points p, (VALUES (0, '2023-09-10'), (1, '2023-10-04'), (2, '2023-09-22')) brk(b, break_after))"""
_CLASS = _CI3 + _fit("emg", "e") + _fit("van", "v") + """, cls AS (SELECT ci.*, emg >= fte.mu + fte.sg AS e, van >= ftv.mu + ftv.sg AS v FROM ci JOIN fte ON fte.g = ci.g JOIN ftv ON ftv.g = ci.g)"""
_KEYS = "CAST(azimuth_index AS BIGINT) AS azimuth_index, CAST(range_index AS BIGINT) AS range_index"


def _of_stack(look: tuple) -> str:
    """Emergence points of one stack, taken alone: a whole query, so that several can be joined by UNION ALL."""
    name, factor, more, seen, shift = look
    own = _CLASS.replace("FROM psi_points p,", f"FROM (SELECT * REPLACE (tc_c + (tc_b - tc_c) * {factor}::DOUBLE + {more} AS tc_b) FROM psi_points WHERE {seen}) p,").replace("p.azimuth_index,", "p.point_id, p.azimuth_index,", 1)
    pick = "SELECT *, row_number() OVER (PARTITION BY azimuth_index, range_index ORDER BY emg DESC, break_after) AS place FROM cls WHERE e AND NOT v"
    return f"SELECT '{name}' AS stack_id, point_id, azimuth_index, range_index, emg, break_after, {shift} AS shift FROM (WITH {own.lstrip(', ')} {pick}) WHERE place = 1"


_STACKS_EMG = ", emg AS (" + "\nUNION ALL ".join(map(_of_stack, LOOKS)) + ")"


def _cluster(src: str, step: int) -> str:
    """Smallest ``point_id`` of ``src`` reachable by steps of at most ``step``: definitions up to ``clu``."""
    return f""", cel AS (SELECT point_id, x, y, CAST(floor(x / {step}) AS INT) AS cx, CAST(floor(y / {step}) AS INT) AS cy FROM {src})
  , off AS (SELECT * FROM (VALUES (-1), (0), (1)) p(a), (VALUES (-1), (0), (1)) q(b))
  , lnk AS (SELECT u.point_id AS a, w.point_id AS b FROM (SELECT cel.*, cx + a AS nx, cy + b AS ny FROM cel, off) u JOIN cel w ON w.cx = u.nx AND w.cy = u.ny WHERE u.point_id <> w.point_id AND (u.x - w.x) ** 2 + (u.y - w.y) ** 2 <= {step * step})
  , clu AS (WITH RECURSIVE t AS (SELECT point_id, point_id AS lab FROM {src} UNION SELECT l.b, t.lab FROM t JOIN lnk l ON l.a = t.point_id WHERE t.lab < l.b) SELECT point_id, min(lab) AS cluster_id FROM t GROUP BY 1)"""


def _evidence(src: str) -> str:
    """Flags and score of the points of ``src``: definitions up to ``conf``."""
    return f""", hit AS (SELECT point_id, rect_id % 4 AS kind FROM {src} JOIN rects ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1)
  , ev AS (SELECT p.point_id, p.x, p.y, coalesce(bool_or(kind = 0), false) AS amplitude_support, coalesce(bool_or(kind = 1), false) AS optical_support, coalesce(bool_or(kind = 2), false) AS optical_reliable, coalesce(bool_or(kind = 3), false) AS context_support
    FROM {src} p LEFT JOIN hit USING (point_id) GROUP BY ALL)
  , conf AS (SELECT *, greatest(0, least(1, 0.65::DOUBLE + 0.2::DOUBLE * amplitude_support::INT + 0.1::DOUBLE * optical_support::INT + 0.05::DOUBLE * context_support::INT - 0.08::DOUBLE * (optical_reliable AND NOT optical_support)::INT)) AS s FROM ev)"""


_DIAMOND = ", dia AS (SELECT rect_id, (x0 + x1) / 2 AS mx, (y0 + y1) / 2 AS my, 200.0::DOUBLE + 20 * (rect_id % 7) AS h FROM rects)"
_EV, _CLUSTER = _evidence("points_xy"), _cluster("points_xy", 24)
_LL = """, ll AS (SELECT point_id, x / 10000.0::DOUBLE * 359 - 179.5 AS lon, y / 10000.0::DOUBLE * 178 - 89 AS lat FROM points_xy), zn AS (SELECT *, least(greatest(CAST(floor((lon + 180) / 6) AS INT) + 1, 1), 60) AS zone FROM ll)"""
_SERIES = " + ".join(f"CAST({a!r} AS DOUBLE) * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1)), " + ".join(f"CAST({a!r} AS DOUBLE) * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1))
#: From ``zn`` (point_id, lon, lat, zone) to ``utm``: Krueger's series, as SQL.
UTM = f""", u AS (SELECT *, sin(radians(lat)) AS s, radians(lon - (6 * zone - 183)) AS lam FROM zn WHERE lat > -80 AND lat < 84), v AS (SELECT *, sinh(atanh(s) - CAST({geo.ECC!r} AS DOUBLE) * atanh(CAST({geo.ECC!r} AS DOUBLE) * s)) AS t FROM u)
, w AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM v)
, utm AS (SELECT *, round(500000 + CAST({geo.K0 * geo.RADIUS!r} AS DOUBLE) * (eta + {_SERIES[0]}), 3) AS easting, round(CASE WHEN lat < 0 THEN 10000000 ELSE 0 END + CAST({geo.K0 * geo.RADIUS!r} AS DOUBLE) * (xi + {_SERIES[1]}), 3) AS northing FROM w)"""

ORACLE_SQL = {
    "scene_filter_s1": duckdb(" SELECT scene_id, day FROM scenes WHERE lower(replace(replace(platform, '-', ''), '_', '')) = 'sentinel1a' AND direction = 'ascending' AND polarization IN ('VV+VH', 'VH+VV') AND mode = 'IW'", "scenes"),
    "scene_filter_s2": duckdb(" SELECT scene_id, round(cloud_cover, 6) AS cloud_cover FROM scenes WHERE cloud_cover < 30", "scenes"),
    "scene_areas": duckdb(f", ar AS ({AREAS}) SELECT DISTINCT scene_id FROM scenes s JOIN ar ON s.x0 <= ar.x1 AND s.x1 >= ar.x0 AND s.y0 <= ar.y1 AND s.y1 >= ar.y0 WHERE cloud_cover < 50", "scenes"),
    "scene_windows": duckdb(f", w AS ({WINDOWS}) SELECT period_id, phase, scene_id, day FROM scenes JOIN w ON day BETWEEN start AND end_day", "scenes"),
    "stack_scenes": duckdb(_STACK + " SELECT * FROM stk", "scenes"),
    "stack_summary": duckdb(_STACK + " SELECT stack_id, count(*) AS scene_count, min(day) AS first_day, max(day) AS last_day, arg_min(scene_id, (day, scene_id)) AS first_scene FROM stk GROUP BY 1", "scenes"),
    "master_centred_window": duckdb(
        _STACK + """, o AS (SELECT *, row_number() OVER (PARTITION BY stack_id ORDER BY day, scene_id) - 1 AS i, count(*) OVER (PARTITION BY stack_id) AS n FROM stk), a AS (SELECT o.stack_id, min(i) AS at0 FROM o JOIN mst ON mst.stack_id = o.stack_id AND day = master_day GROUP BY 1)
  SELECT o.stack_id, scene_id, day FROM o LEFT JOIN a ON a.stack_id = o.stack_id WHERE n >= 5 AND i BETWEEN coalesce(greatest(0, least(at0 - 12, n - 24)), 0) AND coalesce(greatest(0, least(at0 - 12, n - 24)), 0) + 23""", "scenes"),
    "master_secondaries": duckdb(_STACK + " SELECT stack_id, scene_id, day FROM stk JOIN mst USING (stack_id) WHERE day <> master_day", "scenes"),
    "stack_probe": duckdb(_STACK + " SELECT st.stack_id, arg_min(scene_id, (day, scene_id)) AS scene_id, min(day) AS day FROM st LEFT JOIN stk USING (stack_id) GROUP BY 1", "scenes"),
    "missing_dates": duckdb(_STACK + " SELECT DISTINCT stack_id, day FROM stk WHERE (stack_id, day) NOT IN (SELECT (stack_id, day) FROM mon)", "scenes"),
    "date_chunks": duckdb(_STACK + ", b AS (SELECT stack_id, min(day) AS f, max(day) AS l FROM stk GROUP BY 1), e AS (SELECT *, f + CAST(unnest(range(0, (l - f) + 1, 45)) AS INT) AS chunk_start FROM b) SELECT stack_id, chunk_start, least(chunk_start + 44, l) AS chunk_end FROM e", "scenes"),
    "orbit_match": duckdb(_ORBIT + " SELECT scene_id, min(name) AS orbit_file FROM scenes LEFT JOIN fil ON p = 'S1' || upper(right(platform, 1)) AND day BETWEEN a AND e GROUP BY 1", "scenes"),
    "band_audit": duckdb(
        _BAND + """, good AS (SELECT product_id, token, c, count(*) AS n FROM nam WHERE k % 50 <> 3 GROUP BY ALL)
  SELECT product_id, 'unexpected' AS problem, band_name AS detail FROM nam WHERE k % 50 = 3 UNION ALL SELECT product_id, 'duplicate', c || '_VV_' || token FROM good WHERE n > 1
  UNION ALL SELECT product_id, 'missing', CASE WHEN min(c) = 'i' THEN 'q' ELSE 'i' END || '_VV_' || token FROM good GROUP BY product_id, token HAVING count(*) < 2""", "scenes"),
    "band_select": duckdb(_BAND + " SELECT product_id, min(band_name) AS band_name, c || '_VV_' || token AS canonical FROM nam WHERE k % 50 <> 3 GROUP BY product_id, c, token", "scenes"),
    # the answers follow from what was spoilt (g), not from the names
    "coreg_audit": duckdb(
        """, b AS (SELECT *, CASE WHEN g = 3 THEN 'band' WHEN g = 17 OR (g = 19 AND n > 0) THEN 'form' WHEN g = 11 THEN 'pol' WHEN g = 23 THEN 'date' WHEN rep = 1 THEN 'repeat' END AS p FROM coreg_bands)
  SELECT product_id, p AS problem, band_name AS detail FROM b WHERE p IS NOT NULL UNION ALL SELECT product_id, 'pair', token FROM band_days WHERE g IN (3, 7, 11, 17, 23) OR (g = 19 AND n > 0)
  UNION ALL SELECT product_id, 'count', CAST(k AS VARCHAR) FROM (SELECT product_id, count(*) AS k FROM coreg_bands GROUP BY 1) JOIN (SELECT product_id, 2 * count(*) AS want FROM band_days GROUP BY 1) USING (product_id) WHERE k <> want""", "coreg_bands"),
    "ifg_audit": duckdb(
        """, b AS (SELECT *, CASE WHEN g = 11 THEN 'pol' WHEN g = 29 THEN 'master' WHEN g = 23 THEN 'date' WHEN rep = 1 THEN 'repeat' END AS p FROM ifg_bands WHERE n > 0 AND g <> 19)
  SELECT product_id, p AS problem, band_name AS detail FROM b WHERE p IS NOT NULL UNION ALL SELECT product_id, 'pair', token FROM band_days WHERE n > 0 AND g IN (7, 11, 19, 23, 29)
  UNION ALL SELECT product_id, 'ancillary', 'elevation' FROM band_days WHERE n = 0 AND g % 3 <> 1 UNION ALL SELECT product_id, 'ancillary', 'orthorectifiedLon' FROM band_days WHERE n = 0 AND g % 2 = 0""", "ifg_bands"),
    "final_bands": duckdb(" SELECT product_id, band_name, CASE WHEN g = 19 AND n > 0 THEN c || '_VV_slv' || CAST(n AS VARCHAR) || '_' || token ELSE band_name END AS final_name FROM coreg_bands WHERE rep = 0 AND g NOT IN (3, 11, 17, 23)", "coreg_bands"),
    "final_names": duckdb(" SELECT product_id, band_name, CASE WHEN n < 0 THEN NULL WHEN g = 19 THEN 'stacked_ifg' ELSE 'ifg' END AS form, CASE WHEN g = 19 THEN c || '_ifg_VV_' || mst || '_' || token ELSE band_name END AS final_name FROM ifg_bands", "ifg_bands"),
    "export_bands": duckdb(" SELECT product_id, band_name FROM ifg_bands WHERE g <> 11", "ifg_bands"),
    "stack_inputs": duckdb(" SELECT product_id, band_name FROM coreg_bands WHERE n > 0 AND g NOT IN (3, 11)", "coreg_bands"),
    "pair_pivot": duckdb(' SELECT day, min(scene_id) FILTER (k % 3 = 0) AS "IW1", min(scene_id) FILTER (k % 3 = 1) AS "IW2", min(scene_id) FILTER (k % 3 = 2) AS "IW3" FROM scenes GROUP BY day', "scenes"),
    "item_counts": duckdb(
        f""", w AS ({WINDOWS}), h AS (SELECT period_id, phase, platform <> 'sentinel-1b' AND direction = 'ascending' AND polarization IN ('VV', 'VV+VH', 'VH+VV') AND mode = 'IW' AS radar, cloud_cover < 30 AS clear FROM scenes JOIN w ON day BETWEEN start AND end_day)
  SELECT w.period_id, count(*) FILTER (radar AND h.phase = 'before') AS s1_before_items, count(*) FILTER (radar AND h.phase = 'after') AS s1_after_items, count(*) FILTER (clear AND h.phase = 'before') AS s2_before_items, count(*) FILTER (clear AND h.phase = 'after') AS s2_after_items
  FROM (SELECT DISTINCT period_id FROM w) w LEFT JOIN h USING (period_id) GROUP BY 1""", "scenes"),
    "scene_paths": duckdb(
        """ SELECT scene_id, CASE k % 4 WHEN 0 THEN '/bucket/own/' || scene_id || '.SAFE' WHEN 1 THEN '/bucket/alt/' || scene_id WHEN 2 THEN '/eodata/Sentinel-1/SAR/SLC/' || strftime(day, '%Y/%m/%d') || '/S1A_IW_SLC__' || scene_id || '.SAFE'
    ELSE CASE WHEN k % 8 = 3 THEN '/later/' || scene_id END END AS s3_path FROM scenes""", "scenes"),
    "plan_describe": duckdb(
        _PLAN + """, b AS (SELECT stack_id, k, f1, stack_id || '_cdpsi_front_' || strftime(f0, '%Y%m%d') || '_' || strftime(f1, '%Y%m%d') AS front_id, stack_id || '_cdpsi_back_' || strftime(b0, '%Y%m%d') || '_' || strftime(b1, '%Y%m%d') AS back_id FROM plan0)
  , g AS (SELECT stack_id, count(*) AS n, string_agg(strftime(f1, '%Y-%m-%d') || '/' || front_id, ',' ORDER BY k) AS t FROM b GROUP BY 1), r AS (SELECT stack_id, count(DISTINCT x) AS runs FROM (SELECT stack_id, unnest([front_id, back_id]) AS x FROM b) GROUP BY 1)
  SELECT s.stack_id, s.scene_count, CAST(3 AS BIGINT) AS minimum_subset_images, coalesce(n, 0) AS valid_break_count, coalesce(runs, 0) AS subset_run_count, coalesce(n, 0) > 0 AS valid, sha256(t) AS intervals
  FROM (SELECT stack_id, count(*) AS scene_count FROM stk GROUP BY 1) s LEFT JOIN g USING (stack_id) LEFT JOIN r USING (stack_id)""", "scenes"),
    "fusion_export": duckdb(
        _DIAMOND + """, p AS (SELECT count(*) AS n, sum(x) AS total FROM points_xy WHERE point_id % 10 = 0), q AS (SELECT count(*) AS n, sum(1.5 * h * h) AS total FROM dia)
  SELECT 'summary' AS file, p.n, q.n::DOUBLE AS total FROM p, q UNION ALL SELECT 'points.' || f, n, round(total, 6) FROM p, (VALUES ('parquet'), ('geojson')) v(f) UNION ALL SELECT 'polygons.' || f, n, round(total, 6) FROM q, (VALUES ('parquet'), ('geojson')) v(f)""", "points_xy", "rects"),
    "path_derive": duckdb(" SELECT scene_id, '/bucket/a/' || scene_id || CASE WHEN k % 2 = 0 THEN '.SAFE' ELSE '' END AS path, CAST(k AS VARCHAR) || '-ab' AS uuid FROM scenes", "scenes"),
    "cdpsi_breaks": duckdb(
        _PLAN + """ SELECT stack_id, CAST(k - 2 AS INT) AS break_index, CAST(k AS INT) AS n_front, CAST(nb AS INT) AS n_back, f1 AS break_after, b0 AS break_before, stack_id || '_cdpsi_front_' || strftime(f0, '%Y%m%d') || '_' || strftime(f1, '%Y%m%d') AS front_id,
  stack_id || '_cdpsi_back_' || strftime(b0, '%Y%m%d') || '_' || strftime(b1, '%Y%m%d') AS back_id FROM plan0""", "scenes"),
    "subset_master": duckdb(
        _PLAN + """ SELECT plan0.stack_id, CAST(k - 2 AS INT) AS break_index, arg_min(day, (abs(2 * (day - f0) - (f1 - f0)), day)) FILTER (i <= k) AS front_master, arg_min(day, (abs(2 * (day - b0) - (b1 - b0)), day)) FILTER (i > k) AS back_master
  FROM plan0 JOIN ord ON ord.stack_id = plan0.stack_id GROUP BY plan0.stack_id, k""", "scenes"),
    "duplicate_keys": duckdb(" SELECT CAST(r AS BIGINT) AS azimuth_index, CAST(c AS BIGINT) AS range_index, count(*) AS n FROM raw GROUP BY 1, 2 HAVING count(*) > 1", "raw"),
    "pixel_match": duckdb(f" SELECT {_KEYS}, round(tc_c, 6) AS tc_complete, round(tc_f, 6) AS tc_front, round(tc_b, 6) AS tc_back, point_id AS front_point_id, point_id AS back_point_id FROM psi_points", "psi_points"),
    "change_indices": duckdb(_CI + f" SELECT {_KEYS}, CASE WHEN round(van, 6) = 0 THEN 0 ELSE round(van, 6) END AS ci_vanishment, CASE WHEN round(emg, 6) = 0 THEN 0 ELSE round(emg, 6) END AS ci_emergence FROM ci", "psi_points"),
    "mode_bin": duckdb(_CI + _fit("emg", "e") + " SELECT CAST(g AS BIGINT) AS g, n, CAST(bins AS BIGINT) AS bins, round(mode, 6) AS mode FROM mde", "psi_points"),
    "sigma_threshold": duckdb(_CI + _fit("emg", "e") + " SELECT CAST(g AS BIGINT) AS g, n, round(mode, 6) AS mode, round(mu, 6) AS mu, round(sg, 6) AS sigma, round(mu + 3 * sg, 6) AS threshold FROM fte JOIN mde USING (g)", "psi_points"),
    "cdpsi_classes": duckdb(_CLASS + f" SELECT {_KEYS}, break_after, CASE WHEN e AND NOT v THEN 'emergence_candidate' WHEN v AND NOT e THEN 'vanishment_candidate' WHEN e AND v THEN 'ambiguous_change' ELSE 'stable' END AS cdpsi_class FROM cls", "psi_points"),
    "emergence_points": duckdb(_CLASS + f", best AS (SELECT azimuth_index, range_index, max(emg) AS top FROM cls WHERE e AND NOT v GROUP BY ALL) SELECT {_KEYS}, round(top, 6) AS ci_emergence, min(break_after) AS break_after FROM best JOIN cls USING (azimuth_index, range_index) WHERE e AND NOT v AND emg = top GROUP BY azimuth_index, range_index, top", "psi_points"),
    "evidence_flags": duckdb(_EV + " SELECT point_id, amplitude_support, optical_support, optical_reliable, context_support FROM ev", "points_xy", "rects"),
    # a frame of diamonds: places whose distance along the axes lies between half of h and h
    "evidence_polygons": duckdb(
        _DIAMOND + """, hit AS (SELECT point_id, rect_id % 4 AS kind FROM points_xy JOIN dia ON abs(x - mx) + abs(y - my) BETWEEN h / 2 AND h)
  SELECT point_id, coalesce(bool_or(kind = 0), false) AS amplitude_support, coalesce(bool_or(kind = 1), false) AS optical_support, coalesce(bool_or(kind = 2), false) AS optical_reliable, coalesce(bool_or(kind = 3), false) AS context_support FROM points_xy LEFT JOIN hit USING (point_id) GROUP BY 1""", "points_xy", "rects"),
    "polygon_hits": duckdb(
        _DIAMOND + """, n AS (SELECT count(rect_id) AS tp, count(*) - count(rect_id) AS fp FROM points_xy LEFT JOIN dia ON abs(x - mx) + abs(y - my) BETWEEN h / 2 AND h), m AS (SELECT *, greatest((SELECT count(*) FROM rects) - tp, 0) AS fn FROM n), q AS (SELECT *, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn, 0) AS rec FROM m)
  SELECT tp, fp, fn, round(p, 6) AS precision, round(rec, 6) AS recall, round(2 * p * rec / nullif(p + rec, 0), 6) AS f1 FROM q""", "points_xy", "rects"),
    # turned by 45 degrees the squares lie along the axes; moving by (70, 70) moves u by 140 and v not at all
    "pair_overlaps": duckdb(_DIAMOND + """, s AS (SELECT rect_id, h, greatest(0, least(h, 140 + h) - greatest(-h, 140 - h)) * 2 * h / 2 AS whole, greatest(0, least(h, 140 + h / 2) - greatest(-h, 140 - h / 2)) * h / 2 AS hole FROM dia) SELECT rect_id, round(whole - hole, 6) AS shared FROM s""", "rects"),
    "dissolved_area": duckdb(
        """, r AS (SELECT x0, y0, x1, y1 FROM rects UNION ALL SELECT x0 + 100, y0 + 50, x1 + 100, y1 + 50 FROM rects), xs AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx FROM (SELECT x0 AS x FROM r UNION SELECT x1 FROM r)), ys AS (SELECT y, lead(y) OVER (ORDER BY y) AS ny FROM (SELECT y0 AS y FROM r UNION SELECT y1 FROM r))
  SELECT round(sum((nx - x) * (ny - y)), 3) AS area FROM (SELECT DISTINCT x, nx, y, ny FROM r JOIN xs ON xs.x >= r.x0 AND xs.nx <= r.x1 JOIN ys ON ys.y >= r.y0 AND ys.ny <= r.y1)""", "rects"),
    "scene_shapes": duckdb(
        """, part(a0, b0, a1, b1) AS (VALUES (100, -20, 131, -12), (100, -20, 108, 4), (-60, 10, -20, 15), (-60, 45, -20, 50), (-60, 10, -55, 50), (-25, 10, -20, 50))
  SELECT DISTINCT scene_id FROM scenes JOIN part ON x0 <= a1 AND x1 >= a0 AND y0 <= b1 AND y1 >= b0 WHERE cloud_cover < 50""", "scenes"),
    "confidence": duckdb(_EV + " SELECT point_id, round(s, 6) AS confidence_score, CASE WHEN s >= 0.7 THEN 'high' WHEN s >= 0.45 THEN 'medium' ELSE 'low' END AS confidence_class FROM conf", "points_xy", "rects"),
    "point_clusters": duckdb(_CLUSTER + " SELECT point_id, cluster_id FROM clu", "points_xy"),
    # a disc's share: the circle's uncovered angles, as differences of running maxima, and the triangles under them
    "cluster_outlines": duckdb(
        _CLUSTER + """, dsk AS (SELECT DISTINCT cluster_id, x, y FROM clu JOIN points_xy USING (point_id)), cov AS (SELECT a.*, atan2(b.y - a.y, b.x - a.x) - acos(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) / 24) AS lo, 2 * acos(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) / 24) AS w
    FROM dsk a JOIN dsk b ON a.cluster_id = b.cluster_id AND (a.x <> b.x OR a.y <> b.y) AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 < 576)
  , pos AS (SELECT * REPLACE (CASE WHEN lo < 0 THEN lo + 2 * pi() ELSE lo END AS lo) FROM cov), seg AS (SELECT cluster_id, x, y, lo, least(lo + w, 2 * pi()) AS hi FROM pos UNION ALL SELECT cluster_id, x, y, 0, lo + w - 2 * pi() FROM pos WHERE lo + w > 2 * pi() UNION ALL SELECT cluster_id, x, y, 2 * pi(), 2 * pi() FROM dsk)
  , gap AS (SELECT *, coalesce(max(hi) OVER (PARTITION BY cluster_id, x, y ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM seg)
  SELECT cluster_id, round(sum(72 * (lo - g) + 6 * (x * (sin(lo) - sin(g)) - y * (cos(lo) - cos(g)))), 3) AS area, round(sum(12 * (lo - g)), 3) AS perimeter FROM gap WHERE lo > g GROUP BY 1""", "points_xy"),
    "cluster_stats": duckdb(_EV + _CLUSTER + " SELECT cluster_id, count(*) AS point_count, round(avg(s), 6) AS mean_confidence, CASE WHEN avg(s) >= 0.7 THEN 'high' WHEN avg(s) >= 0.45 THEN 'medium' ELSE 'low' END AS confidence_class FROM conf JOIN clu USING (point_id) GROUP BY 1", "points_xy", "rects"),
    "parcel_summary": duckdb(" SELECT rect_id, count(point_id) AS point_count FROM rects LEFT JOIN points_xy ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY 1", "points_xy", "rects"),
    "point_evaluation": duckdb(
        """, n AS (SELECT count(rect_id) AS tp, count(*) - count(rect_id) AS fp FROM points_xy LEFT JOIN rects ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1), m AS (SELECT *, greatest((SELECT count(*) FROM rects) - tp, 0) AS fn FROM n), q AS (SELECT *, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn, 0) AS rec FROM m)
  SELECT tp, fp, fn, round(p, 6) AS precision, round(rec, 6) AS recall, round(2 * p * rec / nullif(p + rec, 0), 6) AS f1 FROM q""", "points_xy", "rects"),
    "polygon_evaluation": duckdb(
        """, mv AS (SELECT x0 + 100 AS x0, y0 + 50 AS y0, x1 + 100 AS x1, y1 + 50 AS y1 FROM rects), q AS (SELECT (SELECT sum((x1 - x0) * (y1 - y0)) FROM mv) AS p, (SELECT sum((x1 - x0) * (y1 - y0)) FROM rects) AS r,
  (SELECT coalesce(sum((least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0))), 0) FROM mv a JOIN rects b ON a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1) AS i)
  SELECT round(p, 6) AS predicted_area, round(r, 6) AS reference_area, round(i, 6) AS intersection_area, round(p - r, 6) AS area_delta, round(i / nullif(p + r - i, 0), 6) AS iou FROM q""", "rects"),
    # turned by 45 degrees the squares lie along the axes: u = x + y, v = x - y, twice the area
    "polygon_overlap": duckdb(
        """, dia AS (SELECT (x0 + x1) / 2 AS mx, (y0 + y1) / 2 AS my, 200.0::DOUBLE + 20 * (rect_id % 7) AS h FROM rects), p AS (SELECT mx + my + 140 AS u, mx - my AS v, h * f AS h, sgn FROM dia, (VALUES (1.0::DOUBLE, 1), (0.5::DOUBLE, -1)) z(f, sgn)), q AS (SELECT mx + my AS u, mx - my AS v, h FROM dia)
  , t AS (SELECT (SELECT sum(sgn * 2 * h * h) FROM p) AS pa, (SELECT sum(2 * h * h) FROM q) AS qa, (SELECT sum(sgn * (least(p.u + p.h, q.u + q.h) - greatest(p.u - p.h, q.u - q.h)) * (least(p.v + p.h, q.v + q.h) - greatest(p.v - p.h, q.v - q.h)) / 2)
    FROM p JOIN q ON abs(p.u - q.u) < p.h + q.h AND abs(p.v - q.v) < p.h + q.h) AS i)
  SELECT round(pa, 6) AS predicted_area, round(qa, 6) AS reference_area, round(i, 6) AS intersection_area, round(pa - qa, 6) AS area_delta, round(i / (pa + qa - i), 6) AS iou FROM t""", "rects"),
    "points_in_polygons": duckdb(" SELECT point_id, rect_id FROM points_xy JOIN rects ON abs(x - (x0 + x1) / 2) + abs(y - (y0 + y1) / 2) <= 200 + 20 * (rect_id % 7)", "points_xy", "rects"),
    "psi_pipeline": duckdb(
        _CLASS.replace("(p.tc_b - p.tc_c) * CASE", "p.point_id, p.tc_c + (p.tc_b - p.tc_c) * CASE").replace("END AS emg", "END - p.tc_c AS emg")
        + ", top AS (SELECT azimuth_index, range_index, max(emg) AS top FROM cls WHERE e AND NOT v GROUP BY ALL), emp AS (SELECT 'asc0/' || CAST(point_id AS VARCHAR) AS point_id, range_index * 20.0::DOUBLE AS x, azimuth_index * 20.0::DOUBLE AS y, min(break_after) AS break_after FROM top JOIN cls USING (azimuth_index, range_index) WHERE e AND NOT v AND emg = top GROUP BY ALL)"
        + _evidence("emp") + _cluster("emp", 20) + " SELECT point_id AS key, break_after, round(s, 6) AS confidence_score, CASE WHEN s >= 0.7 THEN 'high' WHEN s >= 0.45 THEN 'medium' ELSE 'low' END AS confidence_class, cluster_id FROM conf JOIN clu USING (point_id) JOIN emp USING (point_id)", "psi_points", "rects"),
    "stacks_emergence": duckdb(_STACKS_EMG + f" SELECT stack_id, {_KEYS}, round(emg, 6) AS ci_emergence, break_after FROM emg", "psi_points"),
    "stacks_pipeline": duckdb(
        _STACKS_EMG + ", emp AS (SELECT stack_id || '/' || CAST(point_id AS VARCHAR) AS point_id, range_index * 20.0::DOUBLE + shift AS x, azimuth_index * 20.0::DOUBLE AS y, break_after FROM emg)"
        + _evidence("emp") + _cluster("emp", 20) + " SELECT point_id AS key, break_after, round(s, 6) AS confidence_score, CASE WHEN s >= 0.7 THEN 'high' WHEN s >= 0.45 THEN 'medium' ELSE 'low' END AS confidence_class, cluster_id FROM conf JOIN clu USING (point_id) JOIN emp USING (point_id)", "psi_points", "rects"),
    "ring_measures": duckdb(" SELECT rect_id, round((x1 - x0) * (y1 - y0), 6) AS area, round(2 * (x1 - x0 + y1 - y0), 6) AS length FROM rects", "rects"),
    "points_in_rings": duckdb(" SELECT point_id, rect_id FROM points_xy JOIN rects ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1", "points_xy", "rects"),
    "utm_zone": duckdb(_LL + " SELECT point_id, CAST(zone AS BIGINT) AS zone, 'EPSG:' || CASE WHEN lat <= -80 OR lat >= 84 THEN '3857' ELSE CAST(CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + zone AS VARCHAR) END AS crs FROM zn", "points_xy"),
    "utm_project": duckdb(_LL + UTM + " SELECT point_id, CAST(zone AS BIGINT) AS zone, easting, northing FROM utm", "points_xy"),
    # the degrees come back as they were: a round trip to a millimetre; the transverse series are those of utm_project, on the table's side of the equator
    "table_projection": duckdb(
        ", tab(k, name, crs, zone, lon0, wide, lat0, high, off) AS (VALUES " + ", ".join(f"({k}, '{name}', '{crs}', {int(crs[-2:])}, {lon0}::DOUBLE, {wide}::DOUBLE, {lat0}::DOUBLE, {high}::DOUBLE, {10000000 if name == 'south' else 0})" for k, (name, crs, lon0, wide, lat0, high) in enumerate(TABLES)) + ")"
        + ", zn AS (SELECT point_id, name, crs, zone, off, x / 10000.0::DOUBLE * wide + lon0 AS lon, y / 10000.0::DOUBLE * high + lat0 AS lat FROM points_xy JOIN tab ON k = point_id % 3)" + UTM.replace("lat > -80 AND lat < 84", "name <> 'polar'")
        + """ SELECT point_id, name, crs, easting AS x, round(northing - CASE WHEN lat < 0 THEN 10000000 ELSE 0 END + off, 3) AS y, round(lon, 8) AS lon, round(lat, 8) AS lat FROM utm
  UNION ALL SELECT point_id, name, crs, round(6378137 * radians(lon), 3), round(6378137 * asinh(tan(radians(lat))), 3), round(lon, 8), round(lat, 8) FROM zn WHERE name = 'polar'""", "points_xy"),
    "snap_centers": duckdb(
        """, b AS (SELECT rect_id, floor((x0 + 3) / 30) * 30 AS minx, floor((y0 + 7) / 30) * 30 AS miny, ceil(x1 / 30) * 30 AS maxx, ceil(y1 / 30) * 30 AS maxy FROM rects) SELECT *, CAST((maxx - minx) / 30 + 1 AS BIGINT) AS width, CAST((maxy - miny) / 30 + 1 AS BIGINT) AS height FROM b""", "rects"),
    "snap_bounds": duckdb(
        """, b AS (SELECT rect_id, floor((x0 + 3) / 30) * 30 AS minx, floor((y0 + 7) / 30) * 30 AS miny, ceil(x1 / 30) * 30 AS maxx, ceil(y1 / 30) * 30 AS maxy FROM rects) SELECT *, CAST((maxx - minx) / 30 AS BIGINT) AS width, CAST((maxy - miny) / 30 AS BIGINT) AS height FROM b""", "rects"),
}
