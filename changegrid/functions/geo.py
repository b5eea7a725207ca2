"""Coordinate reference systems as Column expressions: UTM zones, projections both ways, snapped grids."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of WGS 84 and UTM: equatorial radius, flattening, scale, false easting and southern northing.
A, FLAT, K0, EASTING, NORTHING = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0
_N = FLAT / (2 - FLAT)
#: Fixed values, Krueger series: rectifying radius, and coefficients to the sixth power of the third flattening.
RADIUS = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180 - 127 * _N**5 / 288 + 7891 * _N**6 / 37800,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440 + 281 * _N**5 / 630 - 1983433 * _N**6 / 1935360,
    61 * _N**3 / 240 - 103 * _N**4 / 140 + 15061 * _N**5 / 26880 + 167603 * _N**6 / 181440,
    49561 * _N**4 / 161280 - 179 * _N**5 / 168 + 6601661 * _N**6 / 7257600,
    34729 * _N**5 / 80640 - 3418889 * _N**6 / 1995840,
    212378941 * _N**6 / 319334400,
)
BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360 - 81 * _N**5 / 512 + 96199 * _N**6 / 604800,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440 + 46 * _N**5 / 105 - 1118711 * _N**6 / 3870720,
    17 * _N**3 / 480 - 37 * _N**4 / 840 - 209 * _N**5 / 4480 + 5569 * _N**6 / 90720,
    4397 * _N**4 / 161280 - 11 * _N**5 / 504 - 830251 * _N**6 / 7257600,
    4583 * _N**5 / 161280 - 108847 * _N**6 / 3991680,
    20648693 * _N**6 / 638668800,
)
ECC = 2 * math.sqrt(_N) / (1 + _N)


def utm_zone(lon: Column) -> Column:
    return F.least(F.greatest(F.floor((lon + 180) / 6) + 1, F.lit(1)), F.lit(60)).cast("int")


def metric_crs(lon: Column, lat: Column) -> Column:
    """EPSG code of the UTM zone (326xx north, 327xx south); 3857 near the poles."""
    code = F.when(lat >= 0, F.lit(32600)).otherwise(F.lit(32700)) + utm_zone(lon)
    return F.concat(F.lit("EPSG:"), F.when((lat <= -80) | (lat >= 84), F.lit(3857)).otherwise(code).cast("string"))


def _transverse(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """Metres from the zone's central meridian and from the equator."""
    phi, lam = F.radians(lat), F.radians(lon - (6 * zone - 183))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - ECC * F.atanh(ECC * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(ALPHA, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return K0 * RADIUS * east, K0 * RADIUS * north


def utm_forward(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """(easting, northing) in metres of a point in the given zone, on its own side of the equator, by the Krueger series."""
    east, north = _transverse(lon, lat, zone)
    return EASTING + east, F.when(lat < 0, F.lit(NORTHING)).otherwise(F.lit(0.0)) + north


def crs_number(crs: str) -> int:
    """The number of ``EPSG:n``, which must be a UTM zone (326nn, 327nn), 3857 or 4326."""
    number = int(crs.removeprefix("EPSG:")) if crs.removeprefix("EPSG:").isdigit() else 0
    if number not in (3857, 4326) and not (number // 100 in (326, 327) and 1 <= number % 100 <= 60):
        raise ValueError(f"no projection for {crs}")
    return number


def forward(crs: str, lon: Column, lat: Column) -> tuple[Column, Column]:
    """(x, y) of degrees in one system for a whole table, so distances hold across it, also over the equator."""
    number = crs_number(crs)
    if number == 4326:
        return lon, lat
    if number == 3857:
        return web_mercator(lon, lat)
    east, north = _transverse(lon, lat, F.lit(number % 100))
    return EASTING + east, north + (NORTHING if number >= 32700 else 0.0)


def inverse(crs: str, x: Column, y: Column) -> tuple[Column, Column]:
    """(lon, lat) in degrees of metres in ``crs``."""
    number = crs_number(crs)
    if number == 4326:
        return x, y
    if number == 3857:
        return F.degrees(x / A), F.degrees(2 * F.atan(F.exp(y / A)) - math.pi / 2)
    xi0, eta0 = (y - (NORTHING if number >= 32700 else 0.0)) / (K0 * RADIUS), (x - EASTING) / (K0 * RADIUS)
    xi, eta = xi0, eta0
    for j, b in enumerate(BETA, 1):
        xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    lam = F.atan2(F.sinh(eta), F.cos(xi))
    # the conformal latitude's isometric one, then the fixed point of psi = atanh(s) - e atanh(e s)
    psi = F.asinh(F.sin(xi) / F.sqrt(F.sinh(eta) * F.sinh(eta) + F.cos(xi) * F.cos(xi)))
    s = F.tanh(psi)
    for _ in range(6):
        s = F.tanh(psi + ECC * F.atanh(ECC * s))
    return F.degrees(lam) + (6 * (number % 100) - 183), F.degrees(F.asin(s))


def project(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """Metres in the zone or, near the poles, where ``metric_crs`` says 3857, in web Mercator."""
    polar = (lat <= -80) | (lat >= 84)
    return tuple(F.when(polar, m).otherwise(u) for m, u in zip(web_mercator(lon, lat), utm_forward(lon, lat, zone), strict=True))


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * A, A * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2))


def snap_bounds(x0: Column, y0: Column, x1: Column, y1: Column, resolution: float, alignment: str = "edge") -> dict[str, Column]:
    """Bounds snapped outward to multiples of the resolution, and the size in pixels.

    ``alignment``: multiples of the resolution are pixels' edges, or their centres, which takes one pixel more each way.
    """
    if alignment not in ("edge", "center"):
        raise ValueError("alignment is edge or center")
    out = {"minx": F.floor(x0 / resolution) * resolution, "miny": F.floor(y0 / resolution) * resolution, "maxx": F.ceil(x1 / resolution) * resolution, "maxy": F.ceil(y1 / resolution) * resolution}
    more = int(alignment == "center")
    return out | {"width": F.round((out["maxx"] - out["minx"]) / resolution).cast("int") + more, "height": F.round((out["maxy"] - out["miny"]) / resolution).cast("int") + more}
