"""Neighbourhood operators on sparse masks: tables that hold only the true pixels.

Work grows with the true pixels, not with the grid, and with a disk's rows, not with its pixels: each true
pixel gives on where its disk begins and ends in every row of the grid, and a running sum along the row counts
the disks that cover a pixel.  ``keys`` name further columns that separate rasters (a period).
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def disk(radius: int) -> list[tuple[int, int]]:
    """Offsets with dr^2 + dc^2 <= radius^2."""
    span = range(-radius, radius + 1)
    return [(a, b) for a in span for b in span if a * a + b * b <= radius * radius]


def _covered(mask: DataFrame, radius: int, height: int, width: int, keys: list[str]) -> DataFrame:
    """``(*keys, r, c, n)``: how many true pixels lie within the disk of each pixel of the grid, where any does."""
    half = [(dr, isqrt(radius * radius - dr * dr)) for dr in range(-radius, radius + 1)]
    ends = F.explode(F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"), F.lit(by).alias("by")) for dr, w in half for dc, by in ((-w, 1), (w + 1, -1))]))
    moved = mask.select(*keys, "r", "c").distinct().select(*keys, "r", "c", ends.alias("e")).select(*keys, (F.col("r") + F.col("e.dr")).alias("r"), (F.col("c") + F.col("e.dc")).alias("c"), "e.by")
    steps = moved.where((F.col("r") >= 0) & (F.col("r") < height)).groupBy(*keys, "r", "c").agg(F.sum("by").alias("by")).where("by <> 0")
    line = Window.partitionBy(*keys, "r").orderBy("c")
    runs = steps.select(*keys, "r", "c", F.sum("by").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("n"), F.lead("c").over(line).alias("to"))
    runs = runs.select(*keys, "r", "n", F.greatest("c", F.lit(0)).alias("from"), F.least(F.col("to") - 1, F.lit(width - 1)).alias("to")).where("n > 0 AND `from` <= `to`")
    return runs.select(*keys, "r", F.explode(F.sequence("from", "to")).alias("c"), "n")


def dilate(mask: DataFrame, radius: int, height: int, width: int, keys: list[str] | None = None) -> DataFrame:
    """Pixels of the grid with any true pixel within the disk."""
    keys = keys or []
    return _covered(mask, radius, height, width, keys).select(*keys, "r", "c")


def erode(mask: DataFrame, radius: int, height: int, width: int, keys: list[str] | None = None) -> DataFrame:
    """Pixels whose whole disk is true; outside the grid nothing is."""
    keys = keys or []
    return _covered(mask, radius, height, width, keys).where(F.col("n") == len(disk(radius))).select(*keys, "r", "c")


def close(mask: DataFrame, radius: int, height: int, width: int, keys: list[str] | None = None) -> DataFrame:
    """Dilation, then erosion; radius 0 changes nothing. Pixels near the border can go."""
    if radius == 0:
        return mask.select(*(keys or []), "r", "c").distinct()
    return erode(dilate(mask, radius, height, width, keys), radius, height, width, keys)


def disk_density(mask: DataFrame, radius: int, height: int, width: int, keys: list[str] | None = None) -> DataFrame:
    """``(r, c, density)``: true part of the disk, outside counting as false; pixels of density 0 are left out."""
    keys = keys or []
    return _covered(mask, radius, height, width, keys).select(*keys, "r", "c", (F.col("n") / len(disk(radius))).alias("density"))
