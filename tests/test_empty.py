"""Empty tables in, empty tables with the full schema out; object paths of scenes."""

import pytest
from pyspark.sql import functions as F

from changegrid.operators import bands as N
from changegrid.operators import catalog as C
from changegrid.operators import psi as S
from changegrid.operators import raster as R
from changegrid.operators import spatial as X
from changegrid.operators import zones as Z
from changegrid.operators.discs import disc_unions

RINGS = "array<array<struct<x: double, y: double>>>"
POINTS = "point_id long, azimuth_index long, range_index long, temporal_coherence double, x double, y double"
SCENES = "scene_id string, stack_id string, day date, platform string, cloud_cover double, x0 double, y0 double, x1 double, y1 double"
S2 = "period_id string, phase string, scene int, r int, c int, scl int, blue double, green double, red double, nir double, swir1 double"

CASES = {
    "s1": (lambda t: R.change_test(R.s1_composite(t("period_id string, phase string, r int, c int, vv double, vh double"))), {"period_id", "r", "c", "vv_before", "pvalue", "candidate"}),
    "s2": (lambda t: R.optical_support(R.phases(R.s2_composite(t(S2)))), {"period_id", "r", "c", "score", "support", "reliable"}),
    "detection": (lambda t: Z.detect(t("period_id string, r int, c int, candidate boolean"), 9, 9), {"period_id", "r", "c"}),
    "zones": (lambda t: Z.density_zones(t("r int, c int"), 9, 9), {"r", "c"}),
    "polygons": (lambda t: Z.zone_polygons(Z.label_zones(t("r int, c int"))), {"zone_id", "rings", "area_ha", "perim_m", "compactness", "wkt"}),
    "metrics": (lambda t: Z.keep_zones(Z.zone_metrics(t("r int, c int, comp_r int, comp_c int"))), {"zone_id", "area_ha", "perim_m", "compactness"}),
    "clusters": (lambda t: X.cluster_stats(X.cluster_points(t("point_id long, x double, y double, confidence_score double"), 5.0)), {"cluster_id", "point_count", "mean_confidence", "confidence_class"}),
    "outlines": (lambda t: disc_unions(t("cluster_id long, x double, y double"), 5.0, ["cluster_id"]), {"cluster_id", "area", "perimeter", "rings"}),
    "evidence": (lambda t: X.confidence(X.evidence_flags(t("point_id long, x double, y double"), t(f"rings {RINGS}, kind string"))), {"point_id", "amplitude_support", "confidence_score", "confidence_class"}),
    "matches": (lambda t: S.change_indices(S.match_points(t(POINTS), t(POINTS), t(POINTS))), {"azimuth_index", "tc_complete", "tc_front", "tc_back", "ci_emergence"}),
    "thresholds": (lambda t: S.sigma_threshold(t("g int, v double"), "v", ["g"]), {"g", "n", "mode", "mu", "sigma", "threshold"}),
    "plans": (lambda t: S.describe_plan(t(SCENES), S.plan_breaks(t(SCENES))), {"stack_id", "scene_count", "valid_break_count", "break_intervals", "valid"}),
    "parcels": (lambda t: X.parcel_summary(t("x double, y double"), t("rect_id long, x0 double, y0 double, x1 double, y1 double")), {"rect_id", "point_count"}),
    "scenes": (lambda t: C.filter_optical(t(SCENES), areas=t(f"rings {RINGS}")), {"scene_id", "cloud_cover"}),
    "orbits": (lambda t: C.match_orbits(t(SCENES), C.parse_orbit_files(t("name string"))), {"scene_id", "orbit_file"}),
    "bands": (lambda t: N.audit_coreg(t("product_id string, band_name string, position int"), t("product_id string, token string, master boolean")), {"product_id", "problem", "detail"}),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_empty_tables_keep_their_schema(spark, name):
    build, columns = CASES[name]
    out = build(lambda schema: spark.createDataFrame([], schema))
    assert columns <= set(out.columns) and out.collect() == []


def test_empty_evaluation(spark):
    points, rects = spark.createDataFrame([], "x double, y double"), spark.createDataFrame([], "x0 double, y0 double, x1 double, y1 double")
    row = X.evaluate_points(points, rects).first()
    assert (row.tp, row.fp, row.fn, row.precision, row.f1) == (0, 0, 0, None, None)
    row = X.evaluate_polygons(*[spark.createDataFrame([], f"rings {RINGS}")] * 2).first()
    assert (row.predicted_area, row.intersection_area, row.iou) == (0, 0, None)
    report = R.run_areas(*[spark.createDataFrame([], "first_change int")] * 2, zones=spark.createDataFrame([], "r int"), polygons=spark.createDataFrame([], "area_ha double")).first()
    assert (report.raw_ha, report.zone_mask_ha, report.polygon_count, report.zone_area_ha) == (0, 0, 0, 0)


def test_scene_paths(spark):
    """Preferred assets first, then the manifest, then any; own links before alternates; else name and date; else none."""
    plain = lambda href, **alt: (href, {k: (v,) for k, v in alt.items()})
    rows = [
        ("x", {"vv": plain("s3://b/x.SAFE/m/vv.tiff"), "data": plain("https://h/x", s3="s3://b/k/manifest.safe")}),
        ("x", {"safe_manifest": plain("s3://b/y.SAFE/manifest.safe"), "zz": plain("s3://b/z")}),
        ("S1A_IW_SLC__1", {"data": plain("https://h/x")}),
        ("S1B_IW_SLC__2.SAFE", {}),
        ("S2A_MSIL2A", {"data": plain("https://h/x")}),
    ]
    schema = "name string, assets map<string, struct<href: string, alternate: map<string, struct<href: string>>>>"
    got = spark.createDataFrame(rows, schema).select(C.scene_path(F.col("assets"), ("data",), F.col("name"), F.to_date(F.lit("2024-02-03"))).alias("p")).collect()
    base = "/eodata/Sentinel-1/SAR/SLC/2024/02/03/"
    assert [r.p for r in got] == ["/b/k", "/b/y.SAFE", base + "S1A_IW_SLC__1.SAFE", base + "S1B_IW_SLC__2.SAFE", None]
