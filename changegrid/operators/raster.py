"""Temporal composites, change tests, optical support and fusion on pixel tables.

A raster is a table keyed by ``(period_id, r, c)``; observations add ``phase`` (before / after).  Each
function is one projection or one aggregate with map-side partials, so a period of any size needs one
shuffle on the pixel key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changegrid.config import ChangeTest, Optical
from changegrid.functions import bandmath as B
from changegrid.operators.quantiles import medians

PIXEL = ["period_id", "r", "c"]
BANDS = ["blue", "green", "red", "nir", "swir1"]
#: Decision codes and their labels in reports.
DECISIONS = {
    0: "not_candidate",
    1: "kept_s1_s2_unreliable",
    2: "kept_s1_s2_supported",
    3: "kept_strong_s1_override",
    4: "dropped_s2_reliable_unsupported",
}


def s1_composite(obs: DataFrame, deep: int | None = None) -> DataFrame:
    """Median of each band before and after, side by side: no self-join of phases.

    ``deep``: pixels of more observations are narrowed down by bins (``quantiles.DEEP`` is a good bound); the check is one
    count of the observations by pixel, so it is left to callers whose scenes by pixel are not bounded.
    """
    picked = {f"{b}_{p}": F.when(F.col("phase") == p, F.col(b)) for p in ("before", "after") for b in ("vv", "vh")}
    return medians(obs, PIXEL, picked, deep=deep)


def change_test(composite: DataFrame, cfg: ChangeTest = ChangeTest()) -> DataFrame:
    """Adds ``ratio_vv``, ``ratio_vh``, ``statistic``, ``pvalue`` and ``candidate``."""
    out = composite.withColumns({"ratio_vv": B.change_ratio(F.col("vv_before"), F.col("vv_after")), "ratio_vh": B.change_ratio(F.col("vh_before"), F.col("vh_after")), "statistic": B.lrt_statistic(F.col("vv_before"), F.col("vv_after"), cfg.enl)})
    passed = (F.col("statistic") > cfg.statistic_min) & (F.col("ratio_vv") > cfg.vv_ratio_min) & (F.col("ratio_vh") > cfg.vh_ratio_min)
    return out.withColumns({"pvalue": B.chi2_tail(F.col("statistic")), "candidate": B.holds(passed)})


def usable(cfg: Optical = Optical()) -> tuple[Column, Column]:
    """(clear, usable): the scene class is clear; and no band is missing."""
    clear = B.holds(F.col("scl").isin(list(cfg.clear_classes)))
    whole = F.lit(True)
    for b in BANDS:
        whole = whole & F.col(b).isNotNull()
    return clear, clear & whole


def s2_composite(obs: DataFrame, cfg: Optical = Optical(), deep: int | None = None) -> DataFrame:
    """Median reflectance of usable pixels, counts, fractions and indices of the medians, by pixel and phase.

    Fractions divide by the phase's number of scenes, not by the observations at the pixel; that number is
    one row a phase.  ``deep`` is as in ``s1_composite``.
    """
    clear, use = usable(cfg)
    items = obs.groupBy("period_id", "phase").agg(F.countDistinct("scene").alias("items"))
    reflectance = {b: F.when(use, F.col(b) / 10000) for b in BANDS}
    px = medians(obs, ["period_id", "phase", "r", "c"], reflectance, [F.count_if(clear).alias("clear_count"), F.count_if(use).alias("valid_count")], deep)
    px = px.join(items, ["period_id", "phase"])
    px = px.withColumns({"clear_fraction": F.col("clear_count") / F.greatest("items", F.lit(1)), "valid_fraction": F.col("valid_count") / F.greatest("items", F.lit(1))})
    return px.withColumns(B.spectral_indices()).drop("items")


def phases(composite: DataFrame) -> DataFrame:
    """One row a pixel with every optical value suffixed by its phase; one aggregate, no self-join."""
    values = ["ndvi", "ndbi", "mndwi", "bsi", "clear_count", "clear_fraction", "valid_fraction"]
    picked = [F.max(F.when(F.col("phase") == p, F.col(v))).alias(f"{v}_{p}") for p in ("before", "after") for v in values]
    return composite.groupBy(*PIXEL).agg(*picked)


def optical_support(pixels: DataFrame, cfg: Optical = Optical(), need_indices: bool = True) -> DataFrame:
    """Adds ``score``, ``support`` and ``reliable`` to the output of ``phases``.

    ``need_indices=False`` leaves out the demand that three indices exist on both dates.
    """
    c = F.col
    bsi = (c("bsi_before").isNotNull() & c("bsi_after").isNotNull()) & ((c("bsi_after") > cfg.bsi_after_min) | (c("bsi_after") - c("bsi_before") > cfg.delta_bsi_min))
    tests = [c("ndvi_after") < cfg.ndvi_after_max, c("mndwi_after") < cfg.mndwi_after_max, c("ndbi_after") > cfg.ndbi_after_min, c("ndbi_after") - c("ndbi_before") > cfg.delta_ndbi_min]
    score = sum((B.holds(t).cast("int") for t in tests + ([bsi] if cfg.use_bsi else [])), F.lit(0))
    reliable = F.lit(True)
    for p in ("before", "after"):
        reliable = reliable & (c(f"clear_count_{p}") >= cfg.min_clear_observations) & (c(f"clear_fraction_{p}") >= cfg.min_clear_fraction) & (c(f"valid_fraction_{p}") >= cfg.min_clear_fraction)
        if need_indices:
            for index in ("ndvi", "ndbi", "mndwi"):
                reliable = reliable & c(f"{index}_{p}").isNotNull()
    return pixels.withColumns({"score": score, "support": score >= cfg.support_score_min, "reliable": B.holds(reliable)})


def unavailable_support(pixels: DataFrame) -> DataFrame:
    """Support where no optical data exist: score 0, nothing supported, nothing reliable."""
    return pixels.select(*PIXEL).withColumns({"score": F.lit(0), "support": F.lit(False), "reliable": F.lit(False)})


def soft_fusion(detection: DataFrame, support: DataFrame, cfg: Optical = Optical()) -> DataFrame:
    """Adds ``refined`` and ``decision`` (see DECISIONS) to a detection; a pixel without optical data is unreliable."""
    both = detection.join(support.select(*PIXEL, "support", "reliable"), PIXEL, "left")
    cand, rel, sup = B.holds(F.col("candidate")), B.holds(F.col("reliable")), B.holds(F.col("support"))
    strong = B.holds((F.col("ratio_vv") >= cfg.override_vv_min) & (F.col("ratio_vh") >= cfg.override_vh_min) & (F.col("pvalue") <= cfg.override_pvalue_max)) if cfg.override else F.lit(False)
    decision = F.when(~cand, 0).when(~rel, 1).when(sup, 2).when(strong, 3).otherwise(4)
    return both.withColumns({"support": sup, "reliable": rel, "refined": cand & (~rel | sup | strong), "decision": decision})


def decision_histogram(fused: DataFrame) -> DataFrame:
    """Pixels of each decision, labels without any kept as 0."""
    labels = F.explode(F.array(*[F.struct(F.lit(k).alias("decision"), F.lit(v).alias("label")) for k, v in DECISIONS.items()]))
    frame = fused.sparkSession.range(1).select(labels.alias("x")).select("x.decision", "x.label")
    counts = fused.groupBy("decision").agg(F.count("*").alias("n"))
    return frame.join(counts, "decision", "left").select("decision", "label", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def mean_over(mask: Column, value: Column) -> Column:
    return F.avg(F.when(mask, value))


def period_report(fused: DataFrame, resolution_m: float = 10.0) -> DataFrame:
    """Metrics of each period in one aggregate."""
    area = resolution_m**2 / 10000
    cand, ref = F.col("candidate"), F.col("refined")
    n = F.count_if(cand)
    return fused.groupBy("period_id").agg(
        F.count("*").alias("pixels"), n.alias("candidate_pixels"), (n * area).alias("candidate_area_ha"), F.avg(cand.cast("int")).alias("candidate_fraction"),
        mean_over(cand, F.col("ratio_vv")).alias("mean_ratio_vv"), mean_over(cand, F.col("ratio_vh")).alias("mean_ratio_vh"),
        F.avg(F.col("reliable").cast("int")).alias("reliable_fraction"), F.avg(F.col("support").cast("int")).alias("support_fraction"),
        F.count_if(ref).alias("refined_pixels"), (F.count_if(ref) * area).alias("refined_area_ha"), (n - F.count_if(ref)).alias("removed_pixels"),
        F.try_divide(n - F.count_if(ref), n).alias("removed_fraction"),
    )


def first_change(masks: DataFrame, periods: list[str], mask_col: str = "refined") -> DataFrame:
    """``(r, c, first_change)``: 1-based number, in the given order, of the first period whose mask holds; 0 if none."""
    index = F.element_at(F.create_map(*[F.lit(x) for i, p in enumerate(periods, 1) for x in (p, i)]), F.col("period_id"))
    return masks.groupBy("r", "c").agg(F.coalesce(F.min(F.when(F.col(mask_col), index)), F.lit(0)).alias("first_change"))


def item_counts(items: DataFrame, periods: DataFrame) -> DataFrame:
    """``(period_id, s1_before_items, s1_after_items, s2_before_items, s2_after_items)``, zeros kept.

    ``items``: ``(period_id, phase, sensor, scene_id)``, a scene once in each window that it is in.
    """
    named = {f"{s}_{p}_items": F.count_if((F.col("sensor") == s) & (F.col("phase") == p)) for s in ("s1", "s2") for p in ("before", "after")}
    counts = items.groupBy("period_id").agg(*[v.alias(k) for k, v in named.items()])
    return periods.select("period_id").distinct().join(counts, "period_id", "left").select("period_id", *[F.coalesce(k, F.lit(0)).alias(k) for k in named])


def run_areas(cumulative_raw: DataFrame, cumulative_refined: DataFrame, resolution_m: float = 10.0, zones: DataFrame | None = None, polygons: DataFrame | None = None) -> DataFrame:
    """Areas in hectares ever marked, before and after refinement; with ``zones`` and ``polygons`` also theirs, and the number of polygons."""
    area = resolution_m**2 / 10000
    out = cumulative_raw.agg((F.count_if(F.col("first_change") > 0) * area).alias("raw_ha"))
    out = out.join(cumulative_refined.agg((F.count_if(F.col("first_change") > 0) * area).alias("refined_ha")))
    if zones is not None:
        out = out.join(zones.agg((F.count("*") * area).alias("zone_mask_ha")))
    if polygons is not None:
        out = out.join(polygons.agg(F.count("*").alias("polygon_count"), F.coalesce(F.sum("area_ha"), F.lit(0.0)).alias("zone_area_ha")))
    return out


def confusion(predicted: DataFrame, truth: DataFrame, predicted_col: str, truth_col: str, keys: list[str] | None = None) -> DataFrame:
    """``(*keys, r, c, predicted, truth, confusion)``: 1 TP, 2 FP, 3 FN, 0 TN; a missing value is false."""
    cell = [*(keys or []), "r", "c"]
    both = predicted.select(*cell, F.col(predicted_col).alias("p")).join(truth.select(*cell, F.col(truth_col).alias("t")), cell, "full")
    p, t = F.coalesce(F.col("p").cast("int"), F.lit(0)) > 0, F.coalesce(F.col("t").cast("int"), F.lit(0)) > 0
    return both.select(*cell, p.alias("predicted"), t.alias("truth"), F.when(p & t, 1).when(p, 2).when(t, 3).otherwise(0).alias("confusion"))


def confusion_metrics(cells: DataFrame, resolution_m: float = 10.0) -> DataFrame:
    """Counts, precision, recall, IoU, F1 (NULL over 0) and areas in one row."""
    n = {k: F.count_if(F.col("confusion") == v) for k, v in {"tn": 0, "tp": 1, "fp": 2, "fn": 3}.items()}
    counts = cells.agg(*[v.alias(k) for k, v in n.items()])
    c, area = F.col, resolution_m**2 / 10000
    out = counts.withColumns({"precision": F.try_divide(c("tp"), c("tp") + c("fp")), "recall": F.try_divide(c("tp"), c("tp") + c("fn")), "iou": F.try_divide(c("tp"), c("tp") + c("fp") + c("fn"))})
    return out.withColumns({"f1": F.try_divide(2 * c("precision") * c("recall"), c("precision") + c("recall")), "predicted_ha": (c("tp") + c("fp")) * area, "truth_ha": (c("tp") + c("fn")) * area, "support_pixels": c("tp") + c("fn")})
