"""Connected pixels: tile-local union-find, then contraction of the links across tile borders."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changegrid.operators.components import connected_components
from changegrid.sources.staging import stage


def _label(pdf: pd.DataFrame, eight: bool) -> pd.DataFrame:
    """Smallest (r, c) of each pixel's component inside one tile: links between neighbours, hooked and jumped as arrays."""
    pdf = pdf.sort_values(["r", "c"], kind="stable").reset_index(drop=True)
    r, c = pdf.r.to_numpy(), pdf.c.to_numpy()
    at = np.full((r.max() - r.min() + 2, c.max() - c.min() + 3), -1)
    row, col = r - r.min() + 1, c - c.min() + 1
    own = np.arange(len(pdf))
    at[row, col] = own
    before = np.stack([at[row + a, col + b] for a, b in ((0, -1), (-1, 0), *(((-1, -1), (-1, 1)) if eight else ()))])
    v = np.broadcast_to(own, before.shape)[before >= 0]
    u = before[before >= 0]
    parent = own.copy()
    while len(u):
        p, q = parent[u], parent[v]
        apart = p != q
        if not apart.any():
            break
        u, v = u[apart], v[apart]
        np.minimum.at(parent, np.maximum(p, q)[apart], np.minimum(p, q)[apart])
        while (jumped := parent[parent]).tolist() != parent.tolist():
            parent = jumped
    return pdf.assign(lr=r[parent], lc=c[parent])


def label_components(mask: DataFrame, keys: list[str] | None = None, eight: bool = True, tile: int = 256) -> DataFrame:
    """``(*keys, r, c, comp_r, comp_c)``: the smallest pixel, by row then column, of each pixel's component.

    ``mask`` holds the true pixels; repeats count once.  A tile is at most ``tile`` squared pixels, so a
    group is bounded; only labels on tile borders enter the global step.
    """
    keys = keys or []
    px = mask.select(*keys, F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c")).distinct()
    px = px.withColumns({"tr": F.floor(F.col("r") / tile).cast("int"), "tc": F.floor(F.col("c") / tile).cast("int")})
    schema = T.StructType([*px.schema.fields, T.StructField("lr", T.IntegerType()), T.StructField("lc", T.IntegerType())])
    local = stage(px.groupBy(*keys, "tr", "tc").applyInPandas(lambda pdf: _label(pdf, eight), schema), "pixel-labels")
    edge = local.where((F.col("r") % tile).isin(0, tile - 1) | (F.col("c") % tile).isin(0, tile - 1))
    steps = [(0, 1), (1, 0), *([(1, 1), (1, -1)] if eight else [])]
    step = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in steps]))
    node = F.struct(*keys, "lr", "lc")
    near = edge.select(*keys, "tr", "tc", node.alias("src"), "r", "c", step.alias("s")).select(*keys, "tr", "tc", "src", (F.col("r") + F.col("s.a")).alias("r"), (F.col("c") + F.col("s.b")).alias("c"))
    other = edge.select(*keys, "r", "c", F.col("tr").alias("tr2"), F.col("tc").alias("tc2"), node.alias("dst"))
    links = near.join(other, [*keys, "r", "c"]).where((F.col("tr") != F.col("tr2")) | (F.col("tc") != F.col("tc2"))).select("src", "dst")
    found = connected_components(links).select(*[F.col("node")[k].alias(k) for k in [*keys, "lr", "lc"]], F.col("component")["lr"].alias("cr"), F.col("component")["lc"].alias("cc"))
    both = local.join(found, [*keys, "lr", "lc"], "left")
    return both.select(*keys, "r", "c", F.coalesce("cr", "lr").alias("comp_r"), F.coalesce("cc", "lc").alias("comp_c"))


def component_sizes(labels: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return labels.groupBy(*(keys or []), "comp_r", "comp_c").agg(F.count("*").alias("n"))


def drop_small(mask: DataFrame, least: int, keys: list[str] | None = None, eight: bool = True, tile: int = 256) -> DataFrame:
    """Pixels in components of at least ``least`` pixels; up to 1 changes nothing."""
    keys = keys or []
    if least <= 1:
        return mask.select(*keys, "r", "c").distinct()
    labels = stage(label_components(mask, keys, eight, tile), "pixel-components")
    kept = stage(component_sizes(labels, keys).where(F.col("n") >= least), "pixel-sizes")
    return labels.join(kept, [*keys, "comp_r", "comp_c"], "left_semi").select(*keys, "r", "c")
