import json

import pytest
from pyspark.sql import functions as F

from changegrid.operators.spatial import rect_ring
from changegrid.sources import io


def test_manifest_round_trip(spark, tmp_path):
    item = {"id": "a", "datetime": "2024-01-01T00:00:00Z", "bbox": [0, 0, 1, 1], "properties": {"orbit": "asc"}, "assets": {"vv": {"href": "s3://b/vv", "alternate": {"https": {"href": "https://h/vv"}}}, "vh": {"href": "s3://b/vh"}}}
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"items": [item, item | {"id": "b", "assets": {"x": {"href": "s3://b/x"}}}]}))
    items = io.read_manifest(spark, str(path))
    got = {r.id: r.href for r in items.select("id", io.asset_href(F.col("assets"), "vv").alias("href")).collect()}
    assert got == {"a": "https://h/vv", "b": "s3://b/x"}
    io.write_manifest(items, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_points(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("point_id,azimuth_index,range_index,lon,lat,temporal_coherence\n1,101,202,9.0,0.0,0.9\n2,x,203,9.0,0.0,NaN\n")
    rows = io.read_points(spark, str(path)).orderBy("point_id").collect()
    assert rows[0].azimuth_index == 101 and abs(rows[0].x - 500000) < 1e-3
    assert rows[1].azimuth_index is None and rows[1].temporal_coherence is None
    (tmp_path / "q.csv").write_text("azimuth_index\n1\n")
    with pytest.raises(ValueError):
        io.read_points(spark, str(tmp_path / "q.csv"))
    (tmp_path / "r.csv").write_text("point_id\n1\n")
    with pytest.raises(ValueError):
        io.read_points(spark, str(tmp_path / "r.csv"))


def test_stacks_round_trip(spark, tmp_path):
    names = [f.split(" ")[0] for f in io.SCENE.split(", ")]
    row = {n: "x" for n in names} | {"relative_orbit": 5}
    scenes = spark.createDataFrame([("s", *[row[n] if n != "scene_id" else k for n in names]) for k in ("b", "a")], "stack_id string, " + io.SCENE)
    io.write_stacks(scenes, str(tmp_path / "s"))
    held = io.read_stacks(spark, str(tmp_path / "s" / "*.json"))
    assert [r.scene_id for r in held.collect()] == ["a", "b"]
    assert '"scene_count":2' in spark.read.text(str(tmp_path / "s")).first()[0]


def test_several_stacks_in_one_file_are_all_read(spark, tmp_path):
    names = [f.split(" ")[0] for f in io.SCENE.split(", ")]
    row = {n: "x" for n in names} | {"relative_orbit": 5}
    scenes = spark.createDataFrame([(s, *[row[n] for n in names]) for s in ("s", "t", "u")], "stack_id string, " + io.SCENE).coalesce(1)
    io.write_stacks(scenes, str(tmp_path / "s"))
    assert {r.stack_id for r in io.read_stacks(spark, str(tmp_path / "s"), lines=True).collect()} == {"s", "t", "u"}


def test_vectors_rasters_and_reuse(spark, tmp_path):
    shape = spark.range(1).select(F.lit(1).alias("zone_id"), F.array(rect_ring(F.lit(0), F.lit(0), F.lit(1), F.lit(1))).alias("rings"))
    io.write_vector(shape, str(tmp_path / "z.geojson"))
    line = json.loads(spark.read.text(str(tmp_path / "z.geojson")).first()[0])
    assert line["geometry"]["coordinates"][0][0] == [0.0, 0.0] and line["properties"] == {"zone_id": 1}
    with pytest.raises(ValueError):
        io.write_vector(shape, str(tmp_path / "z.shp"))
    px = spark.createDataFrame([(0, 0, float("nan")), (0, 1, -1.0), (0, 2, 3.0)], "r int, c int, v double")
    io.write_raster(px, str(tmp_path / "ras"), "s1")
    assert [r.v for r in io.read_raster(spark, str(tmp_path / "ras"), -1.0).orderBy("c").collect()] == [None, None, 3.0]
    calls = []

    def build():
        calls.append(1)
        return px

    for _ in range(2):
        io.reuse_or_build(spark, str(tmp_path / "stage"), build, ["v"])
    io.reuse_or_build(spark, str(tmp_path / "stage"), build, ["other"])
    assert len(calls) == 2


def test_shapes_areas_and_exports(spark, tmp_path):
    shape = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 2.0), (2, 5.0, -1.0, 6.0, 1.0)], "cluster_id int, x0 double, y0 double, x1 double, y1 double")
    shape = shape.select("cluster_id", F.array(rect_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])).alias("rings"))
    points = spark.createDataFrame([(7, 1.0, 2.0)], "point_id int, x double, y double")
    io.export_fusion(points, shape, str(tmp_path), intermediate=True)
    for suffix in ("parquet", "geojson"):
        back = io.read_vector(spark, f"{tmp_path}/fused_change_candidates.{suffix}")
        assert sorted((r.cluster_id, r.rings[0][2].x) for r in back.collect()) == [(1, 1.0), (2, 6.0)]
        assert io.read_vector(spark, f"{tmp_path}/cdpsi_emergence_candidates.{suffix}").first().rings[0][0].y == 2.0
    assert tuple(io.area_of_interest(spark, f"{tmp_path}/fused_change_candidates.geojson").first()) == (0.0, -1.0, 6.0, 2.0)
    assert tuple(io.area_of_interest(spark, (1, 2, 3, 4)).first()) == (1.0, 2.0, 3.0, 4.0)
    io.write_run_summary(points, shape, "r1", ["s"], str(tmp_path / "sum"))
    row = spark.read.json(str(tmp_path / "sum")).first()
    assert (row.run_id, row.candidate_points, row.candidate_polygons, row.stacks) == ("r1", 1, 2, ["s"])


def test_backfill(spark):
    scenes = spark.createDataFrame([("a", None), ("b", "kept")], "scene_id string, s3_path string")
    found = spark.createDataFrame([("a", "new"), ("b", "other")], "scene_id string, s3_path string")
    assert {r.scene_id: r.s3_path for r in io.backfill_paths(scenes, found).collect()} == {"a": "new", "b": "kept"}


def test_manifest_is_in_order(spark, tmp_path):
    """The part files, in name order, hold the items by time and id, missing times first."""
    rows = [(f"i{k:03d}", None if k % 9 == 0 else f"2024-01-{1 + k * 7 % 28:02d}T00:00:00Z") for k in range(200)]
    items = spark.createDataFrame([(i, t, None, None, None) for i, t in reversed(rows)], io.ITEM).repartition(6)
    io.write_manifest(items, str(tmp_path / "items"))
    lines = [json.loads(line) for part in sorted((tmp_path / "items").glob("part-*.json")) for line in part.read_text().splitlines()]
    assert [x["id"] for x in lines] == [i for i, t in sorted(rows, key=lambda r: (r[1] or "", r[0]))]
    assert io.read_items(spark, str(tmp_path / "items")).count() == 200
