"""Registered raster queries and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changegrid.functions import bandmath as B
from changegrid.operators import grid as G
from changegrid.operators import neighborhood as N
from changegrid.operators import pixels as P
from changegrid.operators import raster as R
from changegrid.operators import spatial as X
from changegrid.operators import zones as Z
from changegrid.operators.quantiles import medians
from changegrid.plans.fixtures import LAST_ROW, duckdb, grid_rows, view
from changegrid.plans.pipelines import BuiltUp, evaluate_builtup, run_builtup
from changegrid.sources.staging import stage

#: Columns of the rasters; their rows grow with the tables.
SIDE = 48
PERIODS = ["p1", "p2"]
BY = ["period_id"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, counts as longs."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c).cast("long").alias(c) if t in ("int", "bigint") else F.col(c) for c, t in df.dtypes])


def composite(spark, d):
    return R.s1_composite(view(spark, d, "s1_obs"))


def tested(spark, d):
    return R.change_test(composite(spark, d))


def mask(spark, d):
    return tested(spark, d).where("candidate").select(*R.PIXEL)


def optical(spark, d):
    return R.optical_support(R.phases(R.s2_composite(view(spark, d, "s2_obs"))))


def fused(spark, d):
    return R.soft_fusion(tested(spark, d), optical(spark, d))


def detected(spark, d):
    return Z.detect(tested(spark, d), grid_rows(spark, d), SIDE, tile=16)


def zone_mask(spark, d):
    return stage(Z.density_zones(mask(spark, d), grid_rows(spark, d), SIDE, tile=16, keys=BY), "query-zones")


def truth_cells(spark, d):
    truth = view(spark, d, "truth").select(F.explode(F.array(*map(F.lit, PERIODS))).alias("period_id"), "r", "c", F.lit(True).alias("truth"))
    return R.confusion(tested(spark, d), truth, "candidate", "truth", BY)


def aligned(spark, d):
    """Candidates of any period against a truth on cells twice as wide."""
    predicted = tested(spark, d).groupBy("r", "c").agg(F.bool_or("candidate").alias("predicted"))
    truth = view(spark, d, "truth").select(F.floor(F.col("r") / 2).cast("int").alias("r"), F.floor(F.col("c") / 2).cast("int").alias("c"), F.lit(True).alias("truth")).distinct()
    return evaluate_builtup(predicted, truth, scale=0.5)["metrics"]


def builtup(spark, d):
    """The built-up pipeline up to the refined first change of every pixel."""
    cfg = BuiltUp(periods=tuple(PERIODS), height=grid_rows(spark, d), width=SIDE, tile=16)
    return run_builtup(view(spark, d, "s1_obs"), view(spark, d, "s2_obs"), cfg, "cumulative")["cumulative"].select("r", "c", "first_change")


def amplitude(spark, d):
    v = B.amplitude_change(F.col("vv_before"), F.col("vv_after"))
    return composite(spark, d).select(*R.PIXEL, *[x.alias(k) for k, x in v.items()])


def zone_labels(spark, d):
    return Z.label_zones(zone_mask(spark, d), tile=16, keys=BY)


def outlines(spark, d):
    found = Z.zone_outlines(stage(zone_labels(spark, d), "query-outlines"), keys=BY)
    return found.select(*BY, "comp_r", "comp_c", "wkt", F.size("rings").alias("n_rings"), "n_vertices", "simplified_area_ha", "simplified_perim_m")


def traced(spark, d):
    """Zones as traced, without simplification: measures taken from the text of the polygons."""
    found = Z.zone_outlines(stage(zone_labels(spark, d), "query-traced"), tolerance_m=0.0, keys=BY)
    ring = F.explode(F.split(F.regexp_extract("wkt", r"\(\((.*)\)\)", 1), r"\), \(")).alias("ring")
    pair = lambda p: F.struct(*[F.split_part(p, F.lit(" "), F.lit(i + 1)).cast("double").alias(a) for i, a in enumerate("xy")])
    rings = found.select(*BY, "comp_r", "comp_c", ring).withColumn("ring", F.transform(F.split("ring", ", "), pair))
    measured = rings.select(*BY, "comp_r", "comp_c", F.size("ring").alias("k"), X.ring_area(F.col("ring")).alias("area"), X.ring_length(F.col("ring")).alias("length"))
    whole = measured.groupBy(*BY, "comp_r", "comp_c").agg(F.count("*").alias("n_rings"), F.sum(F.col("k") - 1).alias("corners"), (2 * F.max("area") - F.sum("area")).alias("area_m2"), F.sum("length").alias("perim_m"))
    return whole


def zones_kept(spark, d):
    return Z.keep_zones(Z.zone_metrics(stage(zone_labels(spark, d), "query-zone-labels"), keys=BY), keys=BY)


def zone_polygons(spark, d):
    """Zones of every period, simplified, then measured and filtered."""
    found = Z.zone_polygons(stage(zone_labels(spark, d), "query-zone-polygons"), keys=BY)
    return found.select(*BY, "zone_id", "area_ha", "perim_m", "compactness", "wkt")


def cumulative(spark, d, mask_col="refined"):
    return R.first_change(fused(spark, d), PERIODS, mask_col)


def source_grid(spark, d):
    return composite(spark, d).select(*R.PIXEL, F.col("vv_before").alias("v"))


QUERIES = {
    "s1_composite": lambda s, d: rounded(composite(s, d)),
    "deep_medians": lambda s, d: rounded(medians(view(s, d, "s1_obs"), ["period_id", "phase"], {"vv": F.col("vv"), "vh": F.when(F.col("r") % 5 > 0, F.col("vh"))}, [F.count("*").alias("n")], 1000)),
    "s1_ratio_lrt": lambda s, d: rounded(tested(s, d).select(*R.PIXEL, "ratio_vv", "ratio_vh", "statistic")),
    "s1_pvalue": lambda s, d: rounded(tested(s, d).select(*R.PIXEL, "pvalue")),
    "s1_candidates": lambda s, d: rounded(tested(s, d).where("candidate").select(*R.PIXEL)),
    "s2_clear_counts": lambda s, d: rounded(R.s2_composite(view(s, d, "s2_obs")).select("period_id", "phase", "r", "c", "clear_count", "valid_count", "clear_fraction", "valid_fraction")),
    "s2_composite": lambda s, d: rounded(R.s2_composite(view(s, d, "s2_obs")).select("period_id", "phase", "r", "c", *R.BANDS)),
    "s2_indices": lambda s, d: rounded(R.s2_composite(view(s, d, "s2_obs")).select("period_id", "phase", "r", "c", "ndvi", "ndbi", "mndwi", "bsi")),
    "s2_support": lambda s, d: rounded(optical(s, d).select(*R.PIXEL, "score", "support", "reliable")),
    "s2_support_psi": lambda s, d: rounded(R.optical_support(R.phases(R.s2_composite(view(s, d, "s2_obs"))), need_indices=False).select(*R.PIXEL, "score", "support", "reliable")),
    "s2_unavailable": lambda s, d: rounded(R.unavailable_support(composite(s, d))),
    "soft_fusion": lambda s, d: rounded(fused(s, d).select(*R.PIXEL, "refined", "decision")),
    "decision_histogram": lambda s, d: rounded(R.decision_histogram(fused(s, d))),
    "period_report": lambda s, d: rounded(R.period_report(fused(s, d))),
    "cumulative_first_change": lambda s, d: rounded(cumulative(s, d)),
    "run_areas": lambda s, d: rounded(R.run_areas(cumulative(s, d, "candidate"), cumulative(s, d))),
    "run_report": lambda s, d: rounded(R.run_areas(cumulative(s, d, "candidate"), cumulative(s, d), zones=zone_mask(s, d), polygons=zones_kept(s, d))),
    "dilate": lambda s, d: rounded(N.dilate(mask(s, d), 1, grid_rows(s, d), SIDE, BY)),
    "erode": lambda s, d: rounded(N.erode(mask(s, d), 1, grid_rows(s, d), SIDE, BY)),
    "closing": lambda s, d: rounded(N.close(mask(s, d), 1, grid_rows(s, d), SIDE, BY)),
    "disk_density": lambda s, d: rounded(N.disk_density(mask(s, d), 2, grid_rows(s, d), SIDE, BY)),
    "component_sizes": lambda s, d: rounded(P.component_sizes(P.label_components(tested(s, d).where("candidate"), ["period_id"], tile=16), ["period_id"])),
    "small_component_filter": lambda s, d: rounded(P.drop_small(tested(s, d).where("candidate"), 4, ["period_id"], tile=16)),
    "s1_detection": lambda s, d: rounded(detected(s, d)),
    "density_zone_mask": lambda s, d: rounded(zone_mask(s, d)),
    "zone_polygons": lambda s, d: rounded(zone_polygons(s, d)),
    "zones": lambda s, d: rounded(zone_labels(s, d)),
    "zone_metrics": lambda s, d: rounded(zones_kept(s, d)),
    "zone_rings": outlines,
    "zone_traces": lambda s, d: rounded(traced(s, d)),
    "confusion_raster": lambda s, d: rounded(truth_cells(s, d)),
    "confusion_metrics": lambda s, d: rounded(R.confusion_metrics(truth_cells(s, d))),
    "aligned_evaluation": lambda s, d: rounded(aligned(s, d)),
    "builtup_pipeline": lambda s, d: rounded(builtup(s, d)),
    "amplitude_change": lambda s, d: rounded(amplitude(s, d)),
    "regrid_nearest": lambda s, d: rounded(G.regrid_nearest(source_grid(s, d), G.targets(s, grid_rows(s, d) * 4 // 3, 64), 0.75)),
    "regrid_bilinear": lambda s, d: rounded(G.regrid_bilinear(source_grid(s, d), G.targets(s, grid_rows(s, d) * 4 // 3, 64), "v", 0.75, keys=BY), 9),
    "infer_transform": lambda s, d: rounded(G.infer_transform(source_grid(s, d).select((F.col("c") * 10.0 + 5).alias("x"), (1000 - F.col("r") * 10.0).alias("y")))),
}

_COMP = """, comp AS (SELECT period_id, r, c, median(CASE WHEN phase = 'before' THEN vv END) AS vv_before, median(CASE WHEN phase = 'before' THEN vh END) AS vh_before,
  median(CASE WHEN phase = 'after' THEN vv END) AS vv_after, median(CASE WHEN phase = 'after' THEN vh END) AS vh_after FROM s1_obs GROUP BY ALL)
, test0 AS (SELECT *, vv_after / CASE WHEN vv_before IS NOT NULL THEN greatest(vv_before, 1e-6) END AS ratio_vv, vh_after / CASE WHEN vh_before IS NOT NULL THEN greatest(vh_before, 1e-6) END AS ratio_vh,
  CASE WHEN vv_before + vv_after IS NOT NULL THEN greatest(vv_before + vv_after, 1e-6) END AS tot FROM comp)
, test1 AS (SELECT *, CASE WHEN tot IS NOT NULL THEN greatest(0.0, -2 * ln(greatest(pow(vv_before / tot, 4.4) * pow(vv_after / tot, 4.4) * pow(2.0, 8.8), 1e-12))) END AS statistic FROM test0)
, test2 AS (SELECT *, coalesce(statistic > 6.634896601021213 AND ratio_vv > 1.5 AND ratio_vh > 1.05, false) AS candidate, sqrt(statistic / 2) AS z, 1 / (1 + sqrt(statistic / 2) / 2) AS t FROM test1)
, test AS (SELECT *, t * exp(-z * z + (-1.26551223 + t * (1.00002368 + t * (0.37409196 + t * (0.09678418 + t * (-0.18628806 + t * (0.27886807 + t * (-1.13520398 + t * (1.48851587 + t * (-0.82215223 + t * CAST(0.17087277 AS DOUBLE))))))))))) AS pvalue FROM test2)"""
_S2 = """, use AS (SELECT *, scl IN (2, 4, 5, 6, 7) AS clear, scl IN (2, 4, 5, 6, 7) AND blue IS NOT NULL AND green IS NOT NULL AND red IS NOT NULL AND nir IS NOT NULL AND swir1 IS NOT NULL AS ok FROM s2_obs)
, items AS (SELECT period_id, phase, count(DISTINCT scene) AS items FROM s2_obs GROUP BY ALL)
, px AS (SELECT period_id, phase, r, c, median(CASE WHEN ok THEN blue / 10000 END) AS blue, median(CASE WHEN ok THEN green / 10000 END) AS green, median(CASE WHEN ok THEN red / 10000 END) AS red,
  median(CASE WHEN ok THEN nir / 10000 END) AS nir, median(CASE WHEN ok THEN swir1 / 10000 END) AS swir1, count(*) FILTER (clear) AS clear_count, count(*) FILTER (ok) AS valid_count FROM use GROUP BY ALL)
, s2 AS (SELECT px.*, clear_count / greatest(items, 1) AS clear_fraction, valid_count / greatest(items, 1) AS valid_fraction, (nir - red) / greatest(nir + red, 1e-6) AS ndvi, (swir1 - nir) / greatest(swir1 + nir, 1e-6) AS ndbi,
  (green - swir1) / greatest(green + swir1, 1e-6) AS mndwi, ((swir1 + red) - (nir + blue)) / greatest(swir1 + red + nir + blue, 1e-6) AS bsi FROM px JOIN items USING (period_id, phase))
, twin AS (SELECT k.period_id, k.r, k.c, {cols} FROM (SELECT DISTINCT period_id, r, c FROM s2) k
  LEFT JOIN s2 b ON b.period_id = k.period_id AND b.r = k.r AND b.c = k.c AND b.phase = 'before' LEFT JOIN s2 a ON a.period_id = k.period_id AND a.r = k.r AND a.c = k.c AND a.phase = 'after')
, sup0 AS (SELECT *, CAST(coalesce(a_ndvi < 0.35, false) AS INT) + CAST(coalesce(a_mndwi < 0, false) AS INT) + CAST(coalesce(a_ndbi > -0.02, false) AS INT) + CAST(coalesce(a_ndbi - b_ndbi > 0.02, false) AS INT)
  + CAST(coalesce(b_bsi IS NOT NULL AND a_bsi IS NOT NULL AND (a_bsi > 0.02 OR a_bsi - b_bsi > 0.01), false) AS INT) AS score,
  coalesce(b_clear_count >= 2 AND a_clear_count >= 2 AND b_clear_fraction >= 0.15 AND a_clear_fraction >= 0.15 AND b_valid_fraction >= 0.15 AND a_valid_fraction >= 0.15, false) AS counted,
  b_ndvi IS NOT NULL AND b_ndbi IS NOT NULL AND b_mndwi IS NOT NULL AND a_ndvi IS NOT NULL AND a_ndbi IS NOT NULL AND a_mndwi IS NOT NULL AS indexed FROM twin)
, sup AS (SELECT *, score >= 2 AS support, counted AND indexed AS reliable FROM sup0)""".replace("{cols}", ", ".join(f"{p}.{v} AS {p}_{v}" for p in "ab" for v in ("ndvi", "ndbi", "mndwi", "bsi", "clear_count", "clear_fraction", "valid_fraction")))
_FUSED = """, fus0 AS (SELECT test.*, coalesce(sup.support, false) AS support, coalesce(sup.reliable, false) AS reliable, coalesce(ratio_vv >= 2 AND ratio_vh >= 1.15 AND pvalue <= 0.001, false) AS strong FROM test LEFT JOIN sup USING (period_id, r, c))
, fus AS (SELECT *, candidate AND (NOT reliable OR support OR strong) AS refined, CASE WHEN NOT candidate THEN 0 WHEN NOT reliable THEN 1 WHEN support THEN 2 WHEN strong THEN 3 ELSE 4 END AS decision FROM fus0)"""
_MASK = _COMP + ", m AS (SELECT period_id, r, c FROM test WHERE candidate)"
_DISKS = """, d1(a, b) AS (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))
, d2(a, b) AS (SELECT x.a, y.b FROM (VALUES (-2), (-1), (0), (1), (2)) x(a), (VALUES (-2), (-1), (0), (1), (2)) y(b) WHERE x.a * x.a + y.b * y.b <= 4)"""


def _dil(src: str) -> str:
    return f"SELECT DISTINCT period_id, r + a AS r, c + b AS c FROM {src}, d1 WHERE r + a BETWEEN 0 AND {LAST_ROW} AND c + b BETWEEN 0 AND 47"


def _ero(src: str) -> str:
    return f"SELECT period_id, r + a AS r, c + b AS c FROM {src}, d1 WHERE r + a BETWEEN 0 AND {LAST_ROW} AND c + b BETWEEN 0 AND 47 GROUP BY ALL HAVING count(*) = 5"


def _reach(src: str, keys: str, near: str) -> str:
    """Smallest pixel reachable, by label propagation to a fixed point (codes r * 48 + c)."""
    return f""", lab{src} AS (
  WITH RECURSIVE w AS (SELECT {keys} r, c, r * 48 + c AS lab, 0 AS i FROM {src} UNION
    SELECT {', '.join('x.' + k for k in keys.replace(',', ' ').split()) + ',' if keys else ''} x.r, x.c, y.lab, 0 FROM w y JOIN {src} x ON {' AND '.join(f'x.{k} = y.{k}' for k in keys.replace(',', ' ').split()) + ' AND ' if keys else ''} {near} AND y.lab < x.r * 48 + x.c)
  SELECT {keys} r, c, min(lab) AS lab FROM w GROUP BY ALL)"""


_EIGHT, _FOUR = "abs(x.r - y.r) <= 1 AND abs(x.c - y.c) <= 1", "abs(x.r - y.r) + abs(x.c - y.c) = 1"
_CAND = _COMP + ", k AS (SELECT period_id, r, c FROM test WHERE candidate)" + _reach("k", "period_id,", _EIGHT)
_ZONE = (
    _MASK + _DISKS + _reach("m", "period_id,", _EIGHT) + ", big AS (SELECT period_id, lab FROM labm GROUP BY ALL HAVING count(*) >= 6), kept AS (SELECT period_id, r, c FROM labm JOIN big USING (period_id, lab))"
    f", dense AS (SELECT period_id, r + a AS r, c + b AS c FROM kept, d2 WHERE r + a BETWEEN 0 AND {LAST_ROW} AND c + b BETWEEN 0 AND 47 GROUP BY ALL HAVING count(*) / 13.0 >= 0.15)"
    f", grown AS ({_dil('dense')}), zone AS ({_ero('grown')})"
)
_LABELLED = _ZONE + _reach("zone", "period_id,", _FOUR)
_R = "CASE WHEN round({0}, 6) = 0 THEN 0 ELSE round({0}, 6) END AS {0}"


def _pick(*names: str, of: str, keys: str = "period_id, CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c", where: str = "") -> str:
    return f" SELECT {keys}{''.join(', ' + _R.format(n) for n in names)} FROM {of} {where}"


_PH = "period_id, phase, CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c"
_RC = "CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c"
_CELLS = _COMP + """, cells AS (SELECT coalesce(p.period_id, t.period_id) AS period_id, coalesce(p.r, t.r) AS r, coalesce(p.c, t.c) AS c, coalesce(p.candidate, false) AS predicted, t.r IS NOT NULL AS truth
  FROM test p FULL JOIN (SELECT * FROM truth, (VALUES ('p1'), ('p2')) v(period_id)) t ON p.period_id = t.period_id AND p.r = t.r AND p.c = t.c)
, conf AS (SELECT *, CASE WHEN predicted AND truth THEN 1 WHEN predicted THEN 2 WHEN truth THEN 3 ELSE 0 END AS confusion FROM cells)"""
_SRC = _COMP + f", src AS (SELECT period_id, r, c, vv_before AS v FROM test), grid AS (SELECT CAST(floor(i / 64) AS INT) AS r, CAST(i % 64 AS INT) AS c FROM (SELECT unnest(range(0, CAST(({LAST_ROW} + 1) / 3 * 4 * 64 AS BIGINT))) AS i))"
_RATES = """, n AS (SELECT count(*) FILTER (confusion = 0) AS tn, count(*) FILTER (confusion = 1) AS tp, count(*) FILTER (confusion = 2) AS fp, count(*) FILTER (confusion = 3) AS fn FROM conf)
, q AS (SELECT *, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn, 0) AS rec FROM n)
  SELECT tn, tp, fp, fn, round(p, 6) AS precision, round(rec, 6) AS recall, round(tp / nullif(tp + fp + fn, 0), 6) AS iou, round(2 * p * rec / nullif(p + rec, 0), 6) AS f1, round((tp + fp) * 0.01::DOUBLE, 6) AS predicted_ha, round((tp + fn) * 0.01::DOUBLE, 6) AS truth_ha, tp + fn AS support_pixels FROM q"""

ORACLE_SQL = {
    "s1_composite": duckdb(_COMP + _pick("vv_before", "vh_before", "vv_after", "vh_after", of="comp"), "s1_obs"),
    "deep_medians": duckdb(" SELECT period_id, phase, round(median(vv), 6) AS vv, round(median(vh) FILTER (r % 5 > 0), 6) AS vh, count(*) AS n FROM s1_obs GROUP BY ALL", "s1_obs"),
    "s1_ratio_lrt": duckdb(_COMP + _pick("ratio_vv", "ratio_vh", "statistic", of="test"), "s1_obs"),
    "s1_pvalue": duckdb(_COMP + _pick("pvalue", of="test"), "s1_obs"),
    "s1_candidates": duckdb(_COMP + _pick(of="test", where="WHERE candidate"), "s1_obs"),
    "s2_clear_counts": duckdb(_S2 + f" SELECT {_PH}, clear_count, valid_count, round(clear_fraction, 6) AS clear_fraction, round(valid_fraction, 6) AS valid_fraction FROM s2", "s2_obs"),
    "s2_composite": duckdb(_S2 + _pick("blue", "green", "red", "nir", "swir1", of="s2", keys=_PH), "s2_obs"),
    "s2_indices": duckdb(_S2 + _pick("ndvi", "ndbi", "mndwi", "bsi", of="s2", keys=_PH), "s2_obs"),
    "s2_support": duckdb(_S2 + " SELECT period_id, CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, CAST(score AS BIGINT) AS score, support, reliable FROM sup", "s2_obs"),
    "s2_support_psi": duckdb(_S2 + " SELECT period_id, CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, CAST(score AS BIGINT) AS score, support, counted AS reliable FROM sup", "s2_obs"),
    "s2_unavailable": duckdb(_COMP + " SELECT period_id, CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, CAST(0 AS BIGINT) AS score, false AS support, false AS reliable FROM comp", "s1_obs"),
    "soft_fusion": duckdb(_COMP + _S2 + _FUSED + " SELECT period_id, CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, refined, CAST(decision AS BIGINT) AS decision FROM fus", "s1_obs", "s2_obs"),
    "decision_histogram": duckdb(
        _COMP + _S2 + _FUSED + """, lab(decision, label) AS (VALUES (0, 'not_candidate'), (1, 'kept_s1_s2_unreliable'), (2, 'kept_s1_s2_supported'), (3, 'kept_strong_s1_override'), (4, 'dropped_s2_reliable_unsupported'))
  SELECT CAST(lab.decision AS BIGINT) AS decision, label, count(fus.r) AS n FROM lab LEFT JOIN fus ON fus.decision = lab.decision GROUP BY ALL""", "s1_obs", "s2_obs"),
    "period_report": duckdb(
        _COMP + _S2 + _FUSED + """ SELECT period_id, count(*) AS pixels, count(*) FILTER (candidate) AS candidate_pixels, round(count(*) FILTER (candidate) * 0.01::DOUBLE, 6) AS candidate_area_ha, round(avg(candidate::INT), 6) AS candidate_fraction,
  round(avg(ratio_vv) FILTER (candidate), 6) AS mean_ratio_vv, round(avg(ratio_vh) FILTER (candidate), 6) AS mean_ratio_vh, round(avg(reliable::INT), 6) AS reliable_fraction, round(avg(support::INT), 6) AS support_fraction,
  count(*) FILTER (refined) AS refined_pixels, round(count(*) FILTER (refined) * 0.01::DOUBLE, 6) AS refined_area_ha, count(*) FILTER (candidate) - count(*) FILTER (refined) AS removed_pixels,
  round((count(*) FILTER (candidate) - count(*) FILTER (refined)) / nullif(count(*) FILTER (candidate), 0), 6) AS removed_fraction FROM fus GROUP BY period_id""", "s1_obs", "s2_obs"),
    "cumulative_first_change": duckdb(_COMP + _S2 + _FUSED + f" SELECT {_RC}, CAST(coalesce(min(CASE WHEN refined THEN CASE period_id WHEN 'p1' THEN 1 ELSE 2 END END), 0) AS BIGINT) AS first_change FROM fus GROUP BY r, c", "s1_obs", "s2_obs"),
    "run_areas": duckdb(_COMP + _S2 + _FUSED + " SELECT round(count(*) FILTER (a) * 0.01::DOUBLE, 6) AS raw_ha, round(count(*) FILTER (b) * 0.01::DOUBLE, 6) AS refined_ha FROM (SELECT bool_or(candidate) AS a, bool_or(refined) AS b FROM fus GROUP BY r, c)", "s1_obs", "s2_obs"),
    "dilate": duckdb(_MASK + _DISKS + f", x AS ({_dil('m')}) SELECT period_id, {_RC} FROM x", "s1_obs"),
    "erode": duckdb(_MASK + _DISKS + f", x AS ({_ero('m')}) SELECT period_id, {_RC} FROM x", "s1_obs"),
    "closing": duckdb(_MASK + _DISKS + f", g AS ({_dil('m')}), x AS ({_ero('g')}) SELECT period_id, {_RC} FROM x", "s1_obs"),
    "disk_density": duckdb(_MASK + _DISKS + f" SELECT period_id, CAST(r + a AS BIGINT) AS r, CAST(c + b AS BIGINT) AS c, round(count(*) / 13, 6) AS density FROM m, d2 WHERE r + a BETWEEN 0 AND {LAST_ROW} AND c + b BETWEEN 0 AND 47 GROUP BY 1, 2, 3", "s1_obs"),
    "component_sizes": duckdb(_CAND + " SELECT period_id, CAST(floor(lab / 48) AS BIGINT) AS comp_r, CAST(lab % 48 AS BIGINT) AS comp_c, count(*) AS n FROM labk GROUP BY ALL", "s1_obs"),
    "small_component_filter": duckdb(_CAND + f" SELECT period_id, {_RC} FROM labk WHERE (period_id, lab) IN (SELECT (period_id, lab) FROM labk GROUP BY ALL HAVING count(*) >= 4)", "s1_obs"),
    "s1_detection": duckdb(
        _CAND + _DISKS + f""", big AS (SELECT period_id, r, c FROM labk WHERE (period_id, lab) IN (SELECT (period_id, lab) FROM labk GROUP BY ALL HAVING count(*) >= 4))
, g AS (SELECT DISTINCT period_id, r + a AS r, c + b AS c FROM big, d1 WHERE r + a BETWEEN 0 AND {LAST_ROW} AND c + b BETWEEN 0 AND 47)
  SELECT period_id, CAST(r + a AS BIGINT) AS r, CAST(c + b AS BIGINT) AS c FROM g, d1 WHERE r + a BETWEEN 0 AND {LAST_ROW} AND c + b BETWEEN 0 AND 47 GROUP BY 1, 2, 3 HAVING count(*) = 5""", "s1_obs"),
    "density_zone_mask": duckdb(_ZONE + f" SELECT period_id, {_RC} FROM zone", "s1_obs"),
    "zones": duckdb(_LABELLED + f" SELECT period_id, {_RC}, CAST(floor(lab / 48) AS BIGINT) AS comp_r, CAST(lab % 48 AS BIGINT) AS comp_c FROM labzone", "s1_obs"),
    "zone_metrics": duckdb(
        _LABELLED + """, size AS (SELECT period_id, lab, count(*) AS pixels FROM labzone GROUP BY ALL), shared AS (SELECT x.period_id, x.lab, count(*) AS n FROM labzone x JOIN labzone y ON x.period_id = y.period_id AND x.lab = y.lab AND ((y.r = x.r + 1 AND y.c = x.c) OR (y.r = x.r AND y.c = x.c + 1)) GROUP BY ALL)
, met AS (SELECT period_id, lab, pixels, pixels * CAST(0.01 AS DOUBLE) AS area_ha, (4 * pixels - 2 * coalesce(n, 0)) * CAST(10 AS DOUBLE) AS perim_m FROM size LEFT JOIN shared USING (period_id, lab))
  SELECT period_id, CAST(floor(lab / 48) AS BIGINT) AS comp_r, CAST(lab % 48 AS BIGINT) AS comp_c, pixels, round(area_ha, 6) AS area_ha, round(perim_m, 6) AS perim_m, round(4 * pi() * area_ha * 10000 / pow(greatest(perim_m, 1), 2), 6) AS compactness,
  row_number() OVER (PARTITION BY period_id ORDER BY lab) AS zone_id FROM met WHERE area_ha >= 0.05""", "s1_obs"),
    # every corner of a border is a 2 x 2 window with one, two opposite or three pixels of the zone; the Euler number of a
    # 4-connected zone, counted from the same windows, is 1 less its holes
    "zone_traces": duckdb(
        _LABELLED + """, win AS (SELECT period_id, lab, r + a AS wr, c + b AS wc, sum(1) AS n, sum(a * b + (1 - a) * (1 - b)) AS diag FROM labzone, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(a, b) GROUP BY ALL)
, kind AS (SELECT period_id, lab, count(*) FILTER (n = 1) AS q1, count(*) FILTER (n = 3) AS q3, count(*) FILTER (n = 2 AND diag <> 1) AS qd FROM win GROUP BY ALL)
, size AS (SELECT period_id, lab, count(*) AS pixels FROM labzone GROUP BY ALL), shared AS (SELECT x.period_id, x.lab, count(*) AS n FROM labzone x JOIN labzone y ON x.period_id = y.period_id AND x.lab = y.lab AND ((y.r = x.r + 1 AND y.c = x.c) OR (y.r = x.r AND y.c = x.c + 1)) GROUP BY ALL)
  SELECT period_id, CAST(floor(lab / 48) AS BIGINT) AS comp_r, CAST(lab % 48 AS BIGINT) AS comp_c, CAST(2 - (q1 - q3 + 2 * qd) / 4 AS BIGINT) AS n_rings, CAST(q1 + q3 + 2 * qd AS BIGINT) AS corners,
    pixels * CAST(100 AS DOUBLE) AS area_m2, (4 * pixels - 2 * coalesce(n, 0)) * CAST(10 AS DOUBLE) AS perim_m FROM kind JOIN size USING (period_id, lab) LEFT JOIN shared USING (period_id, lab)""", "s1_obs"),
    "confusion_raster": duckdb(_CELLS + f" SELECT period_id, {_RC}, predicted, truth, CAST(confusion AS BIGINT) AS confusion FROM conf", "s1_obs", "truth"),
    "confusion_metrics": duckdb(_CELLS + _RATES, "s1_obs", "truth"),
    "aligned_evaluation": duckdb(
        _COMP + """, pre AS (SELECT r, c, bool_or(candidate) AS predicted FROM test GROUP BY ALL), half AS (SELECT DISTINCT floor(r / 2) AS tr, floor(c / 2) AS tc FROM truth)
, conf AS (SELECT CASE WHEN predicted AND tr IS NOT NULL THEN 1 WHEN predicted THEN 2 WHEN tr IS NOT NULL THEN 3 ELSE 0 END AS confusion FROM pre LEFT JOIN half ON tr = floor((r + 0.5) / 2) AND tc = floor((c + 0.5) / 2))""" + _RATES, "s1_obs", "truth"),
    "builtup_pipeline": duckdb(
        _CAND + _DISKS + f""", big AS (SELECT period_id, r, c FROM labk WHERE (period_id, lab) IN (SELECT (period_id, lab) FROM labk GROUP BY ALL HAVING count(*) >= 4)), g AS ({_dil('big')}), det AS ({_ero('g')})
, own AS (SELECT coalesce(t.period_id, d.period_id) AS period_id, coalesce(t.r, d.r) AS r, coalesce(t.c, d.c) AS c, ratio_vv, ratio_vh, pvalue, d.r IS NOT NULL AS candidate FROM test t FULL JOIN det d ON t.period_id = d.period_id AND t.r = d.r AND t.c = d.c)"""
        + _S2 + _FUSED.replace("test.*", "own.*").replace("FROM test ", "FROM own ") + f" SELECT {_RC}, CAST(coalesce(min(CASE WHEN refined THEN CASE period_id WHEN 'p1' THEN 1 ELSE 2 END END), 0) AS BIGINT) AS first_change FROM fus GROUP BY r, c", "s1_obs", "s2_obs"),
    "amplitude_change": duckdb(_COMP + " SELECT period_id, CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, round(ratio_vv, 6) AS ratio, round(ln(1 + ratio_vv), 6) AS log_ratio, coalesce(ratio_vv >= 1.5 AND ln(1 + ratio_vv) >= 0.9, false) AS candidate FROM test", "s1_obs"),
    "regrid_nearest": duckdb(_SRC + " SELECT period_id, CAST(grid.r AS BIGINT) AS r, CAST(grid.c AS BIGINT) AS c, round(v, 6) AS v FROM grid JOIN src ON src.r = floor((grid.r + 0.5) * 0.75) AND src.c = floor((grid.c + 0.5) * 0.75)", "s1_obs"),
    "regrid_bilinear": duckdb(
        _SRC + """, mid AS (SELECT r, c, (r + 0.5) * 0.75 - 0.5 AS fr, (c + 0.5) * 0.75 - 0.5 AS fc FROM grid), near AS (SELECT mid.*, floor(fr) + a AS sr, floor(fc) + b AS sc, (CASE a WHEN 1 THEN fr - floor(fr) ELSE 1 - fr + floor(fr) END) * (CASE b WHEN 1 THEN fc - floor(fc) ELSE 1 - fc + floor(fc) END) AS w
  FROM mid, (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b))
  SELECT period_id, CAST(near.r AS BIGINT) AS r, CAST(near.c AS BIGINT) AS c, round(sum(w * v) / sum(w), 9) AS v FROM near JOIN src ON src.r = sr AND src.c = sc WHERE v IS NOT NULL AND w > 0 GROUP BY 1, 2, 3""", "s1_obs"),
    "infer_transform": duckdb(
        _SRC + """, px AS (SELECT c * 10.0::DOUBLE + 5 AS x, 1000 - r * 10.0::DOUBLE AS y FROM src), sx AS (SELECT x, x - lag(x) OVER (ORDER BY x) AS s FROM (SELECT DISTINCT x FROM px)), sy AS (SELECT y, y - lag(y) OVER (ORDER BY y) AS s FROM (SELECT DISTINCT y FROM px))
  SELECT a.res_x, a.ox AS origin_x, b.res_y, b.oy AS origin_y FROM (SELECT median(s) AS res_x, min(x) - median(s) / 2 AS ox FROM sx) a, (SELECT median(s) AS res_y, max(y) + median(s) / 2 AS oy FROM sy) b""", "s1_obs"),
}
ORACLE_SQL["run_report"] = f"SELECT * FROM ({ORACLE_SQL['run_areas']}) a, (" + duckdb(
    _LABELLED + """, size AS (SELECT period_id, lab, count(*) * CAST(0.01 AS DOUBLE) AS ha FROM labzone GROUP BY ALL)
  SELECT (SELECT round(count(*) * CAST(0.01 AS DOUBLE), 6) FROM zone) AS zone_mask_ha, count(*) AS polygon_count, round(coalesce(sum(ha), 0), 6) AS zone_area_ha FROM size WHERE ha >= 0.05""", "s1_obs") + ") z"  # fmt: skip
