"""The two composed batch pipelines, from observation or point tables to zones, polygons and reports."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changegrid.config import ChangeTest, Cleaning, Fusion, Optical, Psi, ZoneShape
from changegrid.operators import discs as D
from changegrid.operators import grid as G
from changegrid.operators import psi as S
from changegrid.operators import raster as R
from changegrid.operators import spatial as X
from changegrid.operators import zones as Z
from changegrid.operators.quantiles import DEEP
from changegrid.sources.io import POINT_COLUMNS, require_columns, reuse_or_build
from changegrid.sources.staging import stage

BUILTUP_STAGES = ("composite", "detect_s1", "refine", "cumulative", "zones", "polygons")


@dataclass(frozen=True)
class BuiltUp:
    """Settings of the built-up pipeline; ``height`` and ``width`` are the grid's pixels."""

    periods: tuple[str, ...]
    height: int
    width: int
    resolution_m: float = 10.0
    tile: int = 256
    allow_unavailable: bool = True
    #: Observations of a pixel beyond which its median is narrowed down by bins; None takes all pixels to be shallow.
    deep: int | None = DEEP
    test: ChangeTest = field(default_factory=ChangeTest)
    cleaning: Cleaning = field(default_factory=Cleaning)
    optical: Optical = field(default_factory=Optical)
    zones: ZoneShape = field(default_factory=ZoneShape)


def run_builtup(radar: DataFrame, optical: DataFrame | None, cfg: BuiltUp, stop_after: str = "polygons", store: str | None = None) -> dict[str, DataFrame]:
    """Radar observations, and optical ones if there are any, to zones; every result up to ``stop_after``, by name.

    Each stage is written to the shared folder, so later ones and readers do not compute it again.  With a
    ``store``, a shared folder of this run's own, stages are artifacts there: a later call reads those that are whole and
    were built with the same settings, and builds the rest; support is judged again from the scores read.
    """
    if stop_after not in BUILTUP_STAGES:
        raise ValueError(f"stop_after is one of {BUILTUP_STAGES}")
    if radar.isEmpty():
        raise ValueError("no radar observations")
    out: dict[str, DataFrame] = {}
    # what each stage's result depends on; support is judged anew from its scores, so its least score is not among them
    grid = {k: getattr(cfg, k) for k in ("height", "width", "resolution_m")}
    scores = {k: v for k, v in asdict(cfg.optical).items() if k != "support_score_min"} | {"available": optical is not None}
    tested_by = {"test": asdict(cfg.test)}
    detected_by = tested_by | grid | {"cleaning": asdict(cfg.cleaning)}
    fused_by = detected_by | {"optical": asdict(cfg.optical)} | scores
    ever_by = fused_by | {"periods": cfg.periods}
    settings = {"composite": {}, "tested": tested_by, "detection": detected_by, "support": scores, "refined": fused_by, "cumulative_raw": ever_by, "cumulative": ever_by}

    def keep(name: str, columns: list[str], build: Callable[[], DataFrame]) -> DataFrame:
        if store is None:
            return stage(build(), f"builtup-{name}")
        return reuse_or_build(radar.sparkSession, f"{store}/{name}", build, columns, settings=settings.get(name, ever_by | {"zones": asdict(cfg.zones)}))

    def detection() -> DataFrame:
        kept = Z.detect(tested, cfg.height, cfg.width, cfg.cleaning, cfg.resolution_m, cfg.tile).withColumn("kept", F.lit(True))
        # closing adds pixels: a detection is the closed mask, with the test's values where there are any
        return tested.drop("candidate").join(kept, R.PIXEL, "full").withColumn("candidate", F.coalesce("kept", F.lit(False))).drop("kept")

    def support() -> DataFrame:
        return R.unavailable_support(out["detection"]) if optical is None else R.optical_support(R.phases(R.s2_composite(optical, cfg.optical, cfg.deep)), cfg.optical)

    out["composite"] = keep("composite", [*R.PIXEL, "vv_before", "vv_after"], lambda: R.s1_composite(radar, cfg.deep))
    if stop_after == "composite":
        return out
    tested = keep("tested", [*R.PIXEL, "statistic", "pvalue", "candidate"], lambda: R.change_test(out["composite"], cfg.test))
    out["detection"] = keep("detection", [*R.PIXEL, "ratio_vv", "pvalue", "candidate"], detection)
    if stop_after == "detect_s1":
        return out
    if optical is None and not cfg.allow_unavailable:
        raise ValueError("optical data are missing")
    held = keep("support", [*R.PIXEL, "score", "support", "reliable"], support)
    out["support"] = held.withColumn("support", F.col("score") >= cfg.optical.support_score_min)
    fused = keep("refined", [*R.PIXEL, "refined", "decision"], lambda: R.soft_fusion(out["detection"], out["support"], cfg.optical))
    out["refined"], out["decisions"], out["report"] = fused, R.decision_histogram(fused), R.period_report(fused, cfg.resolution_m)
    if stop_after == "refine":
        return out
    for name, column in (("cumulative_raw", "candidate"), ("cumulative", "refined")):
        out[name] = keep(name, ["r", "c", "first_change"], lambda column=column: R.first_change(fused, list(cfg.periods), column))
    if stop_after == "cumulative":
        return out
    out["areas"] = R.run_areas(out["cumulative_raw"], out["cumulative"], cfg.resolution_m)
    changed = out["cumulative"].where("first_change > 0").select("r", "c")
    out["zones"] = keep("zones", ["r", "c"], lambda: Z.density_zones(changed, cfg.height, cfg.width, cfg.zones, cfg.resolution_m, cfg.tile))
    if stop_after == "zones":
        return out
    labels = lambda: stage(Z.label_zones(out["zones"], cfg.tile), "builtup-labels")
    out["polygons"] = keep("polygons", ["zone_id", "rings", "area_ha", "perim_m", "compactness"], lambda: Z.zone_polygons(labels(), cfg.zones, cfg.resolution_m))
    out["areas"] = R.run_areas(out["cumulative_raw"], out["cumulative"], cfg.resolution_m, out["zones"], out["polygons"])
    return out


def run_psi(points: DataFrame, breaks: DataFrame, evidence: DataFrame | None = None, cfg: Psi = Psi(), fusion: Fusion = Fusion(), outlines: bool = True, gain: Column | None = None) -> dict[str, DataFrame]:
    """Point tables of all stacks and subsets to fused clusters; with ``outlines``, their polygons get rings, area and perimeter.

    ``points``: ``(stack_id, subset_id, point_id, azimuth_index, range_index, temporal_coherence, x, y)``, where
    ``subset_id`` is NULL for the complete stack.  ``breaks``: as ``psi.plan_breaks``.  All breaks run at
    once: the break is a grouping column.  Point ids are unique in a stack only, so keys hold the stack.
    ``gain``, over columns of points and breaks, levels the emergence index before thresholds are fitted.
    """
    require_columns(points, ("stack_id", "subset_id", *POINT_COLUMNS, "x", "y"), "point table")
    require_columns(breaks, ("stack_id", "front_id", "back_id", "break_after", "break_before"), "break plan")
    keys = ["stack_id", "front_id", "back_id", "break_after", "break_before"]
    plan = breaks.select(*keys)
    complete = points.where("subset_id IS NULL").drop("subset_id")
    S.require_unique(complete, "complete", ["stack_id"])
    subsets = points.where("subset_id IS NOT NULL").select("subset_id", *S.KEY, "point_id", "temporal_coherence")
    S.require_unique(subsets, "subsets", ["subset_id"])
    missing = breaks.select(F.explode(F.array("front_id", "back_id")).alias("subset_id")).distinct().join(subsets, "subset_id", "left_anti").limit(5).collect()
    if missing:
        raise ValueError(f"no points for subsets {[r.subset_id for r in missing]}")
    side = lambda c: subsets.join(plan.select(F.col(c).alias("subset_id"), *keys), "subset_id").drop("subset_id")
    matched = S.match_points(complete.join(plan, "stack_id"), side("front_id"), side("back_id"), keys)
    indices = S.change_indices(matched)
    if gain is not None:  # on the index itself: a scaled coherence would be rounded once more
        indices = indices.withColumn("ci_emergence", F.col("ci_emergence") * gain)
    change = stage(S.classify(indices, keys, cfg.sigma_multiplier), "psi-change")
    if change.isEmpty():
        raise ValueError("no pixel is in all three point tables of any break")
    emergence = stage(S.emergence_points(change, ["stack_id"]), "psi-emergence")
    own = emergence.withColumn("key", F.concat_ws("/", "stack_id", F.col("point_id").cast("string")))
    kinds = ("amplitude_support", "optical_support", "optical_reliable", "context_support")
    flagged = own.withColumns({k: F.lit(False) for k in kinds}) if evidence is None else X.evidence_flags(own, evidence, "key")
    scored = stage(X.confidence(flagged, fusion), "psi-scored")
    clustered = stage(X.cluster_points(scored, cfg.cluster_buffer_m, "key"), "psi-clusters")
    stats = X.cluster_stats(clustered, fusion)
    if outlines:
        stats = stats.join(D.disc_unions(clustered, cfg.cluster_buffer_m, ["cluster_id"]), "cluster_id")
    summary = clustered.agg(F.count("*").alias("points"), F.count_distinct("cluster_id").alias("polygons"), F.array_sort(F.collect_set("stack_id")).alias("stacks"))
    return {"change": change, "emergence": emergence, "points": clustered, "polygons": stats, "summary": summary}


def evaluate_builtup(predicted: DataFrame, truth: DataFrame, resolution_m: float = 10.0, scale: float = 1.0, dr: float = 0.0, dc: float = 0.0) -> dict[str, DataFrame]:
    """Confusion raster and metrics of ``(r, c, predicted)`` against ``(r, c, truth)``.

    A truth on another grid is first laid on the predicted one, each cell taking the value at its centre: a
    predicted cell spans ``scale`` truth cells, with its origin ``dr``, ``dc`` of them away.
    """
    if (scale, dr, dc) != (1.0, 0.0, 0.0):
        truth = G.regrid_nearest(truth, predicted.select("r", "c").distinct(), scale, dr, dc)
    cells = stage(R.confusion(predicted, truth, "predicted", "truth"), "evaluation")
    return {"confusion": cells, "metrics": R.confusion_metrics(cells, resolution_m)}
