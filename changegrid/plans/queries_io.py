"""Registered queries that write tables in the formats of the sources and sinks, and read them back, with DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changegrid.operators import catalog as C
from changegrid.operators import raster as R
from changegrid.operators import spatial as X
from changegrid.plans.fixtures import duckdb, view
from changegrid.plans.queries_points import STACKS, UTM, diamonds
from changegrid.plans.queries_raster import _COMP, _RC, rounded
from changegrid.sources import io
from changegrid.sources.staging import shared_dir

#: The value that stands for a missing one in the written raster.
NODATA = -9999.0


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/io/{name}-{uuid.uuid4().hex}"


def items(spark, d) -> DataFrame:
    """Catalogue items of the scenes: properties under several names, some empty; times at the item or at its start."""
    s = view(spark, d, "scenes")
    stamp = F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T05:06:07Z"))
    alias = F.when(F.col("k") % 2 == 0, "sat:orbit_state").otherwise("orbit_state")
    listed = F.concat(F.lit('["'), F.replace("polarization", F.lit("+"), F.lit('","')), F.lit('"]'))
    properties = F.map_from_arrays(
        F.array(alias, F.lit("sat:relative_orbit"), F.lit("sar:polarizations"), F.lit("platform"), F.lit("start_datetime"), F.lit("sensorMode")),
        F.array(F.upper("direction"), F.col("relative_orbit").cast("string"), F.when(F.col("k") % 3 == 0, F.col("polarization")).otherwise(listed), F.col("platform"), F.when(F.col("k") % 5 == 0, "").otherwise(stamp), F.col("mode")),
    )
    box = F.array("x0", "y0", "x1", "y1")
    link = F.struct(F.concat(F.lit("s3://bucket/"), F.col("scene_id")).alias("href"), F.lit(None).cast("map<string, struct<href: string>>").alias("alternate"))
    return s.select(F.col("scene_id").alias("id"), stamp.alias("datetime"), box.alias("bbox"), properties.alias("properties"), F.create_map(F.lit("data"), link).alias("assets"))


def manifest_records(spark, d) -> DataFrame:
    path = _path(spark, "items")
    io.write_manifest(items(spark, d), path)
    held = io.read_items(spark, path)
    found = C.scene_records(held).join(held.select(F.col("id").alias("scene_id"), io.asset_href(F.col("assets"), "data").alias("href")), "scene_id")
    return found.select("scene_id", "platform", "direction", "relative_orbit", "polarization", "mode", "acquisition_start", "day", "href")


def stack_manifests(spark, d) -> DataFrame:
    path = _path(spark, "stacks")
    scenes = C.stack_scenes(view(spark, d, "scenes"), spark.sql(STACKS)).withColumn("acquisition_start", F.date_format("day", "yyyy-MM-dd"))
    io.write_stacks(scenes, path)
    return io.read_stacks(spark, path, lines=True).select("stack_id", "scene_id", "direction", "relative_orbit", "acquisition_start")


def point_export(spark, d) -> DataFrame:
    """Points of one zone written as the point export, longitude and latitude only, and read as metres."""
    path = _path(spark, "points")
    p = view(spark, d, "points_xy")
    p.select("point_id", (F.lit(9.1) + F.col("x") / 10000.0 * 4).alias("lon"), (F.lit(1.0) + F.col("y") / 10000.0 * 60).alias("lat")).write.csv(path, header=True)
    return rounded(io.read_points(spark, path).select("point_id", "x", "y"), 3)


def raster_artifact(spark, d) -> DataFrame:
    """A composite with missing values written as one artifact; read again, by stage reuse, without building."""
    path = _path(spark, "raster")
    built = R.s1_composite(view(spark, d, "s1_obs")).select(*R.PIXEL, F.coalesce("vv_before", F.lit(NODATA)).alias("vv"))
    io.write_raster(built, path, "s1")

    def never() -> DataFrame:
        raise RuntimeError("a whole artifact must not be built again")

    io.reuse_or_build(spark, f"{path}/artifact=s1", never, [*R.PIXEL, "vv"])
    return rounded(io.read_raster(spark, f"{path}/artifact=s1", NODATA).select(*R.PIXEL, "vv"))


def vector_export(spark, d) -> DataFrame:
    """Polygons with holes written as GeoJSON and as Parquet; measures of what is read from each."""
    path = _path(spark, "vector")
    shapes = diamonds(spark, d, hole=True)
    out = None
    for suffix in ("geojson", "parquet"):
        io.write_vector(shapes, f"{path}.{suffix}")
        held = io.read_vector(spark, f"{path}.{suffix}")
        part = held.select(F.col("rect_id").cast("long").alias("rect_id"), F.lit(suffix).alias("format"), F.size("rings").cast("long").alias("n_rings"), X.polygon_area(F.col("rings")).alias("area"))
        out = part if out is None else out.unionByName(part)
    return rounded(out)


QUERIES = {
    "manifest_records": manifest_records,
    "stack_manifests": stack_manifests,
    "point_export": point_export,
    "raster_artifact": raster_artifact,
    "vector_export": vector_export,
}

ORACLE_SQL = {
    "manifest_records": duckdb(
        """ SELECT scene_id, platform, direction, relative_orbit, CASE WHEN k % 3 <> 0 AND polarization IN ('VV+VH', 'VH+VV') THEN 'VH+VV' ELSE polarization END AS polarization, mode,
  strftime(day, '%Y-%m-%d') || 'T05:06:07Z' AS acquisition_start, day, 's3://bucket/' || scene_id AS href FROM scenes""", "scenes"),
    "stack_manifests": duckdb(
        f""", st AS ({STACKS}) SELECT stack_id, scene_id, direction, relative_orbit, strftime(day, '%Y-%m-%d') AS acquisition_start FROM scenes JOIN st USING (direction, relative_orbit)
  WHERE mode = 'IW' AND (level IS NULL OR level = 'L1') AND (product_type IS NULL OR product_type LIKE '%SLC%') AND (st.polarization = 'VV+VH' OR scenes.polarization LIKE '%' || st.polarization || '%')""", "scenes"),
    "point_export": duckdb(", zn AS (SELECT point_id, 9.1::DOUBLE + x / 10000.0::DOUBLE * 4 AS lon, 1::DOUBLE + y / 10000.0::DOUBLE * 60 AS lat, 32 AS zone FROM points_xy)" + UTM + " SELECT point_id, easting AS x, northing AS y FROM utm", "points_xy"),
    "raster_artifact": duckdb(_COMP + f" SELECT period_id, {_RC}, round(vv_before, 6) AS vv FROM comp", "s1_obs"),
    "vector_export": duckdb(", h AS (SELECT rect_id, 200.0::DOUBLE + 20 * (rect_id % 7) AS h FROM rects) SELECT rect_id, format, CAST(2 AS BIGINT) AS n_rings, round(1.5 * h * h, 6) AS area FROM h, (VALUES ('geojson'), ('parquet')) f(format)", "rects"),
}
