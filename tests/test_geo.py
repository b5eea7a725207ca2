"""Projections of whole tables, both ways; grids over shapes; required columns."""

import math

import pytest
from pyspark.sql import functions as F

from changegrid.functions import geo
from changegrid.plans.pipelines import run_psi
from changegrid.sources import io


def meridian(lat, steps=20000):
    """Metres along the meridian from the equator, by Simpson's rule."""
    e2 = geo.FLAT * (2 - geo.FLAT)
    f = lambda t: geo.A * (1 - e2) / (1 - e2 * math.sin(t) ** 2) ** 1.5
    top = math.radians(lat)
    h = top / steps
    return h / 3 * (f(0) + f(top) + sum((4 if k % 2 else 2) * f(k * h) for k in range(1, steps)))


@pytest.mark.parametrize("crs", ["EPSG:32631", "EPSG:32719", "EPSG:3857", "EPSG:4326"])
def test_round_trip(spark, crs):
    middle = {"EPSG:32631": 3.0, "EPSG:32719": -69.0}.get(crs, 0.0)
    points = spark.range(4000).select((middle + F.pmod(F.xxhash64("id"), F.lit(9000)) / 1000 - 4.5).alias("lon"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(168000)) / 1000 - 84).alias("lat"))
    x, y = geo.forward(crs, F.col("lon"), F.col("lat"))
    lon, lat = geo.inverse(crs, F.col("x"), F.col("y"))
    back = points.select("*", x.alias("x"), y.alias("y")).select(F.max(F.abs(lon - F.col("lon"))).alias("lon"), F.max(F.abs(lat - F.col("lat"))).alias("lat")).first()
    assert back.lon < 1e-9 and back.lat < 1e-9  # a tenth of a millimetre


def test_central_meridian(spark):
    """On the zone's meridian the northing is the meridian's length times the scale: to a tenth of a millimetre."""
    rows = spark.createDataFrame([(3.0, float(v)) for v in (1, 20, 45, 67, 83)], "lon double, lat double")
    for r in rows.select("lat", *[v.alias(k) for k, v in zip("xy", geo.forward("EPSG:32631", F.col("lon"), F.col("lat")), strict=True)]).collect():
        assert r.x == pytest.approx(500000, abs=1e-6) and r.y == pytest.approx(geo.K0 * meridian(r.lat), abs=1e-4)
    with pytest.raises(ValueError):
        geo.forward("EPSG:32661", F.lit(0), F.lit(0))


def test_point_tables(spark, tmp_path):
    """A table over the equator keeps its distances; polar ones are web Mercator; x and y need a system."""

    def read(name, text, **kwargs):
        (tmp_path / f"{name}.csv").write_text(text)
        return io.read_points(spark, str(tmp_path / f"{name}.csv"), **kwargs)

    rows = read("equator", "point_id,lon,lat,azimuth_index\n1,3.0,-0.001,5\n2,3.0,0.001,oops\n").orderBy("point_id").collect()
    assert rows[1].y - rows[0].y == pytest.approx(0.9996 * 2 * meridian(0.001), abs=1e-3) and rows[0].crs == "EPSG:32631" and rows[1].azimuth_index is None
    polar = read("polar", "point_id,lon,lat\n1,10,86\n").first()
    assert polar.crs == "EPSG:3857" and polar.x == pytest.approx(math.radians(10) * geo.A)
    assert read("south", "point_id,lon,lat\n1,-69,-33.4\n").first().crs == "EPSG:32719"
    with pytest.raises(ValueError, match="needs crs"):
        read("metres", "point_id,x,y\n1,5,6\n")
    assert tuple(read("metres", "point_id,x,y\n1,5,6\n", crs="EPSG:32631").select("x", "y").first()) == (5.0, 6.0)
    with pytest.raises(ValueError, match="lacks point_id"):
        read("nothing", "id\n1\n")


def test_grid_over_a_shape(spark):
    grid = io.area_grid(io.area_shape(spark, (-7.80, 33.40, -7.70, 33.50)), 10.0).first()
    assert grid.crs == "EPSG:32629" and grid.minx % 10 == 0 and grid.maxx - grid.minx == grid.width * 10 and grid.height == (grid.maxy - grid.miny) / 10
    center = io.area_grid(io.area_shape(spark, (-7.80, 33.40, -7.70, 33.50)), 10.0, "auto", "center").first()
    assert (center.width, center.height, center.minx) == (grid.width + 1, grid.height + 1, grid.minx)
    assert io.area_grid(io.area_shape(spark, (10, 85, 11, 86)), 10.0).first().crs == "EPSG:3857"
    with pytest.raises(ValueError):
        io.area_grid(io.area_shape(spark, (1, 2, 3, 4)), 10.0, alignment="corner")


def test_required_columns(spark):
    with pytest.raises(ValueError, match="point table lacks range_index, x"):
        run_psi(spark.range(1).selectExpr("'a' AS stack_id", "'s' AS subset_id", "id AS point_id", "id AS azimuth_index", "0.5D AS temporal_coherence", "0D AS y"), spark.range(1))
