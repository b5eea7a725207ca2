"""Readers and writers: scene manifests, point exports, pixel tables, vectors and metrics."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changegrid.functions import geo
from changegrid.operators.polygons import dissolve
from changegrid.operators.spatial import rect_ring, ring_area

#: Fixed format: a catalogue item, and the manifest that lists them.
ITEM = "id string, datetime string, bbox array<double>, properties map<string, string>, assets map<string, struct<href: string, alternate: map<string, struct<href: string>>>>"
MANIFEST = f"items array<struct<{', '.join(f.replace(' ', ': ', 1) for f in ('id string', 'datetime string', 'bbox array<double>', 'properties map<string, string>', 'assets map<string, struct<href: string, alternate: map<string, struct<href: string>>>>'))}>>"
#: Fixed format: columns of the point export.
POINTS = (
    "point_id long, x_local_m double, y_local_m double, azimuth_index long, range_index long, lon double, lat double, temporal_coherence double, "
    "scene_elevation_m double, dem_error_phase_per_m double, mean_velocity_mm_yr double, master_day double, n_ifg long, n_image long"
)
SCENE = (
    "scene_id string, product_name string, acquisition_start string, acquisition_stop string, acquisition_date string, direction string, relative_orbit int, polarization string, swath_mode string, "
    "product_type string, processing_level string, platform string, asset_name string, href string, product_uuid string, s3_path string, local_path string"
)
STACK = f"stack_id string, direction string, relative_orbit int, product_type string, scene_count long, scenes array<struct<{SCENE.replace(' ', ':').replace(',:', ',')}>>"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Items of a frozen catalogue ``{"items": [...]}``, one a row."""
    return spark.read.schema(MANIFEST).json(path, multiLine=True).select(F.explode("items").alias("item")).select("item.*")


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items as ``write_manifest`` leaves them, one a line."""
    return spark.read.schema(ITEM).json(path)


def write_manifest(items: DataFrame, path: str) -> None:
    """One item a line, in order of time (missing ones first), then id: sorted ranges, so the part files in name order hold the whole order."""
    items.orderBy(F.col("datetime").asc_nulls_first(), "id").write.mode("overwrite").json(path)


def first_of(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def asset_href(assets: Column, *preferred: str) -> Column:
    """Link of the first preferred asset there is, its https alternate first, else of the first asset."""
    named = []
    for name in preferred:
        asset = F.try_element_at(assets, F.lit(name))
        named += [F.try_element_at(asset["alternate"], F.lit("https"))["href"], asset["href"]]
    return first_of(*named, F.get(F.map_values(assets), F.lit(0))["href"])


def read_stacks(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Scenes of stack manifests, one a row, with their stack's id.

    A file holds one stack, or, with ``lines``, one a line as ``write_stacks`` leaves them.
    """
    stacks = spark.read.schema(STACK).json(path, multiLine=not lines)
    return stacks.select("stack_id", F.explode("scenes").alias("scene")).select("stack_id", "scene.*")


def write_stacks(scenes: DataFrame, path: str) -> None:
    """One stack a line: its scenes in order of start and id, and their number."""
    names = [c for c in scenes.columns if c != "stack_id"]
    key = F.struct(F.col("acquisition_start").alias("_at"), F.col("scene_id").alias("_id"), F.struct(*names).alias("scene"))
    stacks = scenes.groupBy("stack_id").agg(F.first("direction").alias("direction"), F.first("relative_orbit").alias("relative_orbit"), F.first("product_type").alias("product_type"), F.count("*").alias("scene_count"), F.array_sort(F.collect_list(key))["scene"].alias("scenes"))
    stacks.write.mode("overwrite").json(path)


#: Columns that a point table must have to be matched and placed.
POINT_COLUMNS = ("point_id", "azimuth_index", "range_index", "temporal_coherence")


def require_columns(table: DataFrame, columns: tuple[str, ...], label: str) -> DataFrame:
    """The table, or ValueError naming the columns it lacks."""
    lacking = [c for c in columns if c not in table.columns]
    if lacking:
        raise ValueError(f"{label} lacks {', '.join(lacking)}")
    return table


def table_crs(points: DataFrame, lon: str = "lon", lat: str = "lat") -> str:
    """The metric system of a table: by the middle of its bounds, UTM north or south, or 3857 near the poles."""
    middle = [(F.min(c) + F.max(c)) / 2 for c in (lon, lat)]
    return points.agg(geo.metric_crs(*middle)).first()[0] or "EPSG:32631"


def read_points(spark: SparkSession, path: str, crs_zone: int | None = None, crs: str | None = None) -> DataFrame:
    """Point export with ``x``, ``y`` in metres and ``crs``: lon/lat projected, x/y as they are, else local metres.

    One system for the whole table, so distances hold across it: ``crs``, else that of the middle of the points' bounds
    (UTM north or south, 3857 near the poles).  With ``crs_zone`` each point is projected in that zone, on its own
    side of the equator.  Tables with x/y alone need ``crs``.

    Needs ``point_id``, and lon/lat or x/y.  Numbers that do not parse become NULL, as does NaN.
    """
    raw = require_columns(spark.read.csv(path, header=True), ("point_id",), "point export")
    kinds = dict(f.split(" ") for f in POINTS.split(", ")) | {"x": "double", "y": "double"}
    rows = raw.select(*[F.expr(f"try_cast(`{c}` AS {kinds[c]})").alias(c) if c in kinds else F.col(c) for c in raw.columns])
    rows = rows.select(*[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes])
    if {"lon", "lat"} <= set(rows.columns):
        if crs_zone is not None:
            east, north = geo.utm_forward(F.col("lon"), F.col("lat"), F.lit(crs_zone))
            return rows.withColumns({"x": east, "y": north})
        crs = crs or table_crs(rows)
        east, north = geo.forward(crs, F.col("lon"), F.col("lat"))
        return rows.withColumns({"x": east, "y": north, "crs": F.lit(crs)})
    if {"x", "y"} <= set(rows.columns):
        if crs is None:
            raise ValueError("a point export with x and y alone needs crs")
        geo.crs_number(crs)
        return rows.withColumn("crs", F.lit(crs))
    if {"x_local_m", "y_local_m"} <= set(rows.columns):
        return rows.withColumns({"x": F.col("x_local_m"), "y": F.col("y_local_m")})
    raise ValueError("point export has neither lon/lat nor local metres")


def read_raster(spark: SparkSession, path: str, nodata: float | None = None) -> DataFrame:
    """A pixel table; NaN and the nodata value become NULL."""
    rows = spark.read.parquet(path)
    clean = {}
    for c, t in rows.dtypes:
        if t in ("double", "float"):
            v = F.nanvl(F.col(c), F.lit(None).cast(t))
            clean[c] = v if nodata is None else F.nullif(v, F.lit(nodata).cast(t))
    return rows.withColumns(clean) if clean else rows


def write_raster(pixels: DataFrame, path: str, artifact: str, overwrite: bool = False) -> None:
    """One artifact of a raster store; the commit protocol makes the write all or nothing."""
    pixels.write.mode("overwrite" if overwrite else "errorifexists").parquet(f"{path}/artifact={artifact}")


def reuse_or_build(spark: SparkSession, path: str, build, columns: list[str], overwrite: bool = False, settings: dict | None = None) -> DataFrame:
    """A stage artifact: read where it is complete, has ``columns`` and was built with ``settings``, else built, written and read.

    ``settings`` are kept as JSON beside the rows; an artifact without them, or with others, is built again.
    """
    jvm = spark.sparkContext._jvm
    place = lambda name: jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    fs = place("_SUCCESS").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    wanted = None if settings is None else json.dumps(settings, sort_keys=True, default=str)
    if not overwrite and fs.exists(place("_SUCCESS")):
        known = wanted is None
        if not known and fs.exists(place("_settings.json")):
            known = _read_text(fs, place("_settings.json")) == wanted
        held = spark.read.parquet(path)
        if known and set(columns) <= set(held.columns):
            return held
    build().write.mode("overwrite").parquet(path)
    if wanted is not None:
        out = fs.create(place("_settings.json"), True)
        out.write(bytearray(wanted.encode()))
        out.close()
    return spark.read.parquet(path)


def _read_text(fs, path) -> str:
    """A small file of the shared file system."""
    held, size = fs.open(path), fs.getFileStatus(path).getLen()
    try:
        return bytes(held.readNBytes(int(size))).decode()
    finally:
        held.close()


def write_vector(features: DataFrame, path: str, geometry: str = "rings") -> None:
    """``.parquet``, or ``.geojson`` as one feature a line; other suffixes raise ValueError."""
    if path.endswith(".parquet"):
        features.write.mode("overwrite").parquet(path)
    elif path.endswith(".geojson"):
        rest = [c for c in features.columns if c != geometry]
        corners = F.transform(geometry, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
        shape = F.struct(F.lit("Polygon").alias("type"), corners.alias("coordinates"))
        feature = F.struct(F.lit("Feature").alias("type"), F.struct(*rest).alias("properties"), shape.alias("geometry"))
        features.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unsupported vector format: {path}")


def read_vector(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, or GeoJSON of one feature a line: the properties' columns and ``rings``."""
    if not path.endswith(".geojson"):
        return spark.read.parquet(path)
    found = spark.read.json(path)
    corners = F.transform("geometry.coordinates", lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return found.select("properties.*", corners.alias("rings"))


def area_of_interest(spark: SparkSession, bounds: tuple[float, float, float, float] | str) -> DataFrame:
    """One row ``(x0, y0, x1, y1)``: the bounds, or the box around all shapes of a vector file."""
    if not isinstance(bounds, str):
        return spark.range(1).select(*[F.lit(float(v)).alias(c) for c, v in zip(("x0", "y0", "x1", "y1"), bounds, strict=True)])
    corner = read_vector(spark, bounds).select(F.explode(F.flatten("rings")).alias("p"))
    return corner.agg(F.min("p.x").alias("x0"), F.min("p.y").alias("y0"), F.max("p.x").alias("x1"), F.max("p.y").alias("y1"))


def area_shape(spark: SparkSession, bounds: tuple[float, float, float, float] | str) -> DataFrame:
    """One row ``(rings, area)``: the bounds, or all shapes of a vector file dissolved to one, parts and holes kept."""
    if isinstance(bounds, str):
        return dissolve(read_vector(spark, bounds))
    ring = rect_ring(*[F.lit(float(v)) for v in bounds])
    return spark.range(1).select(F.array(ring).alias("rings"), ring_area(ring).alias("area"))


def area_grid(area: DataFrame, resolution_m: float = 10.0, crs: str | None = None, alignment: str = "edge") -> DataFrame:
    """One row ``(crs, minx, miny, maxx, maxy, width, height, resolution_m)``: the grid over a shape in degrees (``rings``).

    Without ``crs``, or with ``auto``, it is the metric system of the middle of the shape's bounds.
    """
    corner = area.select(F.explode(F.flatten("rings")).alias("p")).select(F.col("p.x").alias("lon"), F.col("p.y").alias("lat"))
    crs = table_crs(corner) if crs in (None, "", "auto") else crs
    x, y = geo.forward(crs, F.col("lon"), F.col("lat"))
    box = corner.agg(F.min(x).alias("x0"), F.min(y).alias("y0"), F.max(x).alias("x1"), F.max(y).alias("y1"))
    snapped = geo.snap_bounds(*[F.col(c) for c in ("x0", "y0", "x1", "y1")], resolution_m, alignment)
    return box.select(F.lit(crs).alias("crs"), *[v.alias(k) for k, v in snapped.items()], F.lit(float(resolution_m)).alias("resolution_m"))


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A report of one row, or few, as one JSON file."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def export_fusion(points: DataFrame, polygons: DataFrame, path: str, formats: tuple[str, ...] = ("parquet", "geojson"), intermediate: bool = False, geometry: str = "rings") -> None:
    """The fused polygons, and the candidate points where ``intermediate``, in each format.

    Point tables go out as shapes of one corner, so both formats hold them.
    """
    if intermediate:
        shapes = points.withColumn(geometry, F.array(F.array(F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")))))
        for suffix in formats:
            write_vector(shapes, f"{path}/cdpsi_emergence_candidates.{suffix}", geometry)
    for suffix in formats:
        write_vector(polygons, f"{path}/fused_change_candidates.{suffix}", geometry)


def write_run_summary(points: DataFrame, polygons: DataFrame, run_id: str, stacks: list[str], path: str) -> None:
    """``run_id``, numbers of candidate points and polygons, and the stacks' ids, as one JSON row."""
    counts = points.agg(F.count("*").alias("candidate_points")).join(polygons.agg(F.count("*").alias("candidate_polygons")))
    write_metrics(counts.select(F.lit(run_id).alias("run_id"), "*", F.array(*[F.lit(s) for s in stacks]).alias("stacks")), path)


def backfill_paths(scenes: DataFrame, found: DataFrame) -> DataFrame:
    """Scenes with a missing ``s3_path`` filled from ``(scene_id, s3_path)``."""
    new = found.groupBy("scene_id").agg(F.min("s3_path").alias("new_path"))
    return scenes.join(new, "scene_id", "left").withColumn("s3_path", F.coalesce("s3_path", "new_path")).drop("new_path")
