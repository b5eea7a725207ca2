"""Point-scatterer change: break plans, three-way matches, robust thresholds, classes, emergence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changegrid.config import Psi
from changegrid.sources.staging import stage

KEY = ["azimuth_index", "range_index"]


def _nearest(days: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` (stack_id, cut, side, middle) with ``master``: the stack's day nearest to the middle, the earlier if tied.

    ``middle`` counts half days.  Days and middles are read in one order, so each middle sees the last day
    up to it and the first one after it; no stack's days are gathered or paired.
    """
    half = 2 * F.datediff("day", F.lit("1970-01-01").cast("date"))
    none = F.lit(None)
    own = days.select("stack_id", half.alias("at"), F.lit(0).alias("late"), "day", none.cast("int").alias("cut"), none.cast("string").alias("side"))
    both = own.unionByName(asked.select("stack_id", F.col("middle").alias("at"), F.lit(1).alias("late"), none.cast("date").alias("day"), F.col("cut").cast("int").alias("cut"), "side"))
    order = Window.partitionBy("stack_id").orderBy("at", "late")
    before = F.last("day", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.last("day", ignorenulls=True).over(Window.partitionBy("stack_id").orderBy(F.desc("at"), F.desc("late")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = both.withColumns({"before": before, "after": after}).where("late = 1")
    day = lambda c: 2 * F.datediff(c, F.lit("1970-01-01").cast("date"))
    nearer = F.coalesce(F.col("at") - day("before") <= day("after") - F.col("at"), F.col("before").isNotNull())
    return met.select("stack_id", "cut", "side", F.when(nearer, F.col("before")).otherwise(F.col("after")).alias("master"))


def plan_breaks(scenes: DataFrame, least: int = Psi.minimum_subset_images) -> DataFrame:
    """Every split of each stack's scenes, in order of day, with ``least`` or more on both sides.

    ``scenes``: ``(stack_id, day)``, one row a scene.  Each side's bounds, size and master: the scene
    nearest the middle of the side, the earlier if tied.  A stack too short for a split has no row.
    Windows over the stack give the bounds, one merge of days and middles the masters, so the work grows
    with the number of scenes and not with its square.
    """
    scenes = scenes.select("stack_id", F.col("day").cast("date").alias("day"))
    order, whole = Window.partitionBy("stack_id").orderBy("day"), Window.partitionBy("stack_id")
    cuts = scenes.select("stack_id", "day", F.row_number().over(order).alias("cut"), F.count("*").over(whole).alias("n"), F.min("day").over(whole).alias("first"), F.max("day").over(whole).alias("last"), F.lead("day").over(order).alias("next"))
    cuts = cuts.where((F.col("cut") >= least) & (F.col("n") - F.col("cut") >= least))
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    sides = F.explode(F.array(F.struct(F.lit("front").alias("side"), (day("first") + day("day")).alias("middle")), F.struct(F.lit("back").alias("side"), (day("next") + day("last")).alias("middle"))))
    masters = _nearest(scenes, cuts.select("stack_id", "cut", sides.alias("_side")).select("stack_id", "cut", "_side.*"))
    masters = masters.groupBy("stack_id", "cut").agg(*[F.max(F.when(F.col("side") == s, F.col("master"))).alias(f"{s}_master") for s in ("front", "back")])
    out = cuts.join(masters, ["stack_id", "cut"])
    name = lambda side, a, b: F.concat_ws("_", "stack_id", F.lit(f"cdpsi_{side}"), F.date_format(a, "yyyyMMdd"), F.date_format(b, "yyyyMMdd"))
    return out.select(
        "stack_id", F.col("cut").alias("n_front"), (F.col("n") - F.col("cut")).cast("int").alias("n_back"), F.col("day").alias("break_after"), F.col("next").alias("break_before"), "front_master", name("front", "first", "day").alias("front_id"),
        "back_master", name("back", "next", "last").alias("back_id"), (F.col("cut") - least + 1).alias("break_index"),
    )


def describe_plan(scenes: DataFrame, breaks: DataFrame, least: int = Psi.minimum_subset_images) -> DataFrame:
    """One row a stack: its number of scenes, bounds, breaks and subset runs, the breaks' intervals in order, and whether it has any.

    A subset that several breaks share is one run.
    """
    whole = scenes.groupBy("stack_id").agg(F.count("*").alias("scene_count"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    runs = breaks.select("stack_id", F.explode(F.array("front_id", "back_id")).alias("run")).groupBy("stack_id").agg(F.count_distinct("run").alias("subset_run_count"))
    parts = ["break_index", "break_after", "break_before", "front_id", "back_id", "n_front", "n_back", "front_master", "back_master"]
    listed = breaks.groupBy("stack_id").agg(F.count("*").alias("valid_break_count"), F.array_sort(F.collect_list(F.struct(*parts))).alias("break_intervals"))
    out = whole.join(listed, "stack_id", "left").join(runs, "stack_id", "left").withColumn("minimum_subset_images", F.lit(least))
    zeros = {c: F.coalesce(c, F.lit(0)) for c in ("valid_break_count", "subset_run_count")}
    return out.withColumns(zeros).withColumn("valid", F.col("valid_break_count") > 0)


def require_breaks(plan: DataFrame) -> DataFrame:
    """The plan, or ValueError if no stack can be split."""
    if plan.isEmpty():
        raise ValueError("no stack has enough scenes on both sides of any break")
    return plan


def duplicate_keys(points: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Pixel keys that occur more than once, with their count."""
    keys = [*(by or []), *KEY]
    return points.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(points: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """The points, or ValueError naming the first five repeated keys."""
    found = duplicate_keys(points, by).orderBy(*(by or []), *KEY).limit(5).collect()
    if found:
        raise ValueError(f"{label}: repeated pixel keys {[tuple(r)[:-1] for r in found]}")
    return points


def match_points(complete: DataFrame, front: DataFrame, back: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Points of the three coherence tables that share a pixel (and ``by``): two co-partitioned joins on one key."""
    keys = [*(by or []), *KEY]
    f = front.select(*keys, F.col("point_id").alias("front_point_id"), F.col("temporal_coherence").alias("tc_front"))
    b = back.select(*keys, F.col("point_id").alias("back_point_id"), F.col("temporal_coherence").alias("tc_back"))
    return complete.withColumnRenamed("temporal_coherence", "tc_complete").join(f, keys).join(b, keys)


def change_indices(matched: DataFrame) -> DataFrame:
    """Adds ``ci_vanishment`` (front - complete) and ``ci_emergence`` (back - complete); NaN and infinities count as missing."""
    clean = {c: F.when(F.abs(F.nanvl(F.col(c), F.lit(float("inf")))) < float("inf"), F.col(c)) for c in ("tc_complete", "tc_front", "tc_back")}
    out = matched.withColumns(clean)
    return out.withColumns({"ci_vanishment": F.col("tc_front") - F.col("tc_complete"), "ci_emergence": F.col("tc_back") - F.col("tc_complete")})


def central_mode(values: DataFrame, value: str, by: list[str]) -> DataFrame:
    """``(*by, n, lo, hi, bins, mode)``: centre of the first fullest of max(20, floor(sqrt n)) equal bins.

    The last bin is closed; constant values spread over +-0.5; a single value is its own mode.  Bins are
    counted by two grouped aggregates; no group's values gather in one place.
    """
    v = values.where(F.col(value).isNotNull())
    span = v.groupBy(*by).agg(F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = span.select(*by, "n", F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"), F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"), F.greatest(F.lit(20), F.floor(F.sqrt("n"))).cast("int").alias("bins"))
    at = F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("bins")).cast("int"), F.col("bins") - 1)
    counted = v.join(span, by).groupBy(*by, "n", "lo", "hi", "bins", at.alias("bin")).agg(F.count("*").alias("k"))
    top = counted.groupBy(*by, "n", "lo", "hi", "bins").agg(F.max(F.struct("k", (-F.col("bin")).alias("neg"))).alias("top"))
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    centre = F.when(F.col("n") == 1, (F.col("lo") + F.col("hi")) / 2).otherwise(F.col("lo") + (-F.col("top.neg") + 0.5) * width)
    return top.select(*by, "n", "lo", "hi", "bins", centre.alias("mode"))


def sigma_threshold(values: DataFrame, value: str, by: list[str], sigma: float = Psi.sigma_multiplier) -> DataFrame:
    """``(*by, n, mode, mu, sigma, threshold)``: the stable side mirrored at the mode, refitted within 3 sigma.

    The refit's width is always 3; ``sigma`` scales the threshold only.  Groups of fewer than two values
    give no row.
    """
    modes = central_mode(values, value, by).where("n > 1").select(*by, "n", "mode")
    x, m = F.col(value), F.col("mode")
    side = values.where(x.isNotNull()).join(modes, by).where(x <= m)
    both = side.select(*by, "n", "mode", F.explode(F.when(x < m, F.array(x, 2 * m - x)).otherwise(F.array(x))).alias("x"))
    first = both.groupBy(*by, "n", "mode").agg(F.avg("x").alias("m1"), F.stddev_pop("x").alias("s1"))
    inside = both.join(first.select(*by, "m1", "s1"), by)
    inside = inside.where((F.col("s1") == 0) | F.abs(F.col("x") - F.col("m1")).between(0, 3 * F.col("s1")))
    second = inside.groupBy(*by, "n", "mode", "m1", "s1").agg(F.avg("x").alias("m2"), F.stddev_pop("x").alias("s2"))
    mu, sd = F.when(F.col("s1") == 0, F.col("m1")).otherwise(F.col("m2")), F.when(F.col("s1") == 0, 0.0).otherwise(F.col("s2"))
    return second.select(*by, "n", "mode", mu.alias("mu"), sd.alias("sigma"), (mu + sigma * sd).alias("threshold"))


def require_fits(points: DataFrame, by: list[str]) -> DataFrame:
    """The points, or ValueError naming groups with fewer than two finite values of either index."""
    counts = points.groupBy(*by).agg(F.count("ci_emergence").alias("e"), F.count("ci_vanishment").alias("v"))
    short = counts.where("e < 2 OR v < 2").orderBy(*by).limit(5).collect()
    if short:
        raise ValueError(f"fewer than two finite values to fit a threshold on: {[tuple(r)[:-2] for r in short]}")
    return points


def classify(points: DataFrame, by: list[str], sigma: float = Psi.sigma_multiplier) -> DataFrame:
    """Adds both thresholds and ``cdpsi_class``; thresholds are one row a group, joined back.

    The points are staged, as each fit reads them several times.  A group too small for a fit is an error.
    """
    points = require_fits(stage(points, "psi-points"), by)
    out = points
    for name in ("emergence", "vanishment"):
        fit = sigma_threshold(points, f"ci_{name}", by, sigma).select(*by, F.col("threshold").alias(f"ci_{name}_threshold"), F.col("mu").alias(f"ci_{name}_mu"), F.col("sigma").alias(f"ci_{name}_sigma"), F.col("mode").alias(f"ci_{name}_mode"))
        out = out.join(stage(fit, "psi-fit"), by)
    e = F.coalesce(F.col("ci_emergence") >= F.col("ci_emergence_threshold"), F.lit(False))
    v = F.coalesce(F.col("ci_vanishment") >= F.col("ci_vanishment_threshold"), F.lit(False))
    return out.withColumn("cdpsi_class", F.when(e & ~v, "emergence_candidate").when(v & ~e, "vanishment_candidate").when(e & v, "ambiguous_change").otherwise("stable"))


def emergence_points(classified: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One emergence candidate a pixel of each stack: the largest index, then the earliest break.

    Pixel keys of different stacks are unrelated, so ``by`` must name the stack wherever there may be several.
    """
    order = Window.partitionBy(*(by or []), *KEY).orderBy(F.desc("ci_emergence"), F.asc("break_before"), F.asc("break_after"))
    return classified.where("cdpsi_class = 'emergence_candidate'").withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")
