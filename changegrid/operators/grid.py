"""Grids of pixel tables: inferred transforms, and nearest or bilinear regridding as equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def infer_transform(pixels: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """``(res_x, res_y, origin_x, origin_y)``: median step of the distinct coordinates, and the first cell's outer corner.

    Steps are taken over distinct coordinates (one axis of the raster), not over pixels.
    """
    out = None
    for axis, sign in ((x, 1), (y, -1)):
        line = pixels.select(F.col(axis).alias("v")).where(F.col(axis).isNotNull()).distinct()
        step = line.withColumn("step", F.col("v") - F.lag("v").over(Window.orderBy("v")))
        first = F.min("v") if sign > 0 else F.max("v")
        part = step.agg(F.median("step").alias(f"res_{axis}"), first.alias("first"))
        part = part.select(f"res_{axis}", (F.col("first") - sign * F.col(f"res_{axis}") / 2).alias(f"origin_{axis}"))
        out = part if out is None else out.join(part)
    return out


def targets(spark, height: int, width: int) -> DataFrame:
    """``(r, c)`` of every cell of a grid."""
    return spark.range(height * width).select(F.floor(F.col("id") / width).cast("int").alias("r"), (F.col("id") % width).cast("int").alias("c"))


def regrid_nearest(source: DataFrame, grid: DataFrame, scale: float, dr: float = 0.0, dc: float = 0.0) -> DataFrame:
    """Values of the source cell that holds each target cell's centre.

    A target cell spans ``scale`` source cells; ``dr``, ``dc`` shift its origin, in source cells.
    """
    at = grid.withColumns({"sr": F.floor((F.col("r") + 0.5) * scale + dr).cast("int"), "sc": F.floor((F.col("c") + 0.5) * scale + dc).cast("int")})
    held = source.withColumnsRenamed({"r": "sr", "c": "sc"})
    return at.join(held, ["sr", "sc"]).drop("sr", "sc")


def regrid_bilinear(source: DataFrame, grid: DataFrame, value: str, scale: float, dr: float = 0.0, dc: float = 0.0, keys: list[str] | None = None) -> DataFrame:
    """``(*keys, r, c, value)``: the four source cells around each target centre, weighted; missing ones are left out.

    ``keys`` separate rasters of the source; all are laid on one grid.
    """
    keys = keys or []
    fr, fc = (F.col("r") + 0.5) * scale + dr - 0.5, (F.col("c") + 0.5) * scale + dc - 0.5
    base = grid.withColumns({"r0": F.floor(fr), "c0": F.floor(fc), "wr": fr - F.floor(fr), "wc": fc - F.floor(fc)})
    four = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)]))
    weight = F.when(F.col("o.a") == 1, F.col("wr")).otherwise(1 - F.col("wr")) * F.when(F.col("o.b") == 1, F.col("wc")).otherwise(1 - F.col("wc"))
    each = base.select("r", "c", "r0", "c0", "wr", "wc", four.alias("o")).select("r", "c", (F.col("r0") + F.col("o.a")).cast("int").alias("sr"), (F.col("c0") + F.col("o.b")).cast("int").alias("sc"), weight.alias("w")).where("w > 0")
    held = source.where(F.col(value).isNotNull()).select(*keys, F.col("r").alias("sr"), F.col("c").alias("sc"), F.col(value).alias("v"))
    return each.join(held, ["sr", "sc"]).groupBy(*keys, "r", "c").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias(value))
