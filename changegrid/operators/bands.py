"""Band names of radar products: a grammar of name forms drives parsing, selection, renaming and audits.

An inventory is ``(product_id, band_name, position)``, one row a band in the product's order.  What a product should hold is
``(product_id, token, master)``: one row a scene date, true for the master's.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed formats: parts of a name, the forms built from them, and the bands beside the pairs of an interferogram product.
PARTS = {"component": "[iq]", "pol": "[^_]+", "date": r"\d{2}[A-Za-z]{3}\d{4}", "of": r"\d{2}[A-Za-z]{3}\d{4}", "index": r"\d+"}
FORMS = {
    "master": "{component}_{pol}_mst_{date}",
    "slave": "{component}_{pol}_slv{index}_{date}",
    "stacked_slave": "{component}_{pol}_slv1_{date}_slv{index}_{of}",
    "ifg": "{component}_ifg_{pol}_{of}_{date}",
    "stacked_ifg": "{component}_ifg_{pol}_{of}_{date}_slv{index}_{again}",
}
ANCILLARY = ("elevation", "orthorectifiedLat", "orthorectifiedLon")
#: What the stacked forms are called in a final product.
RENAMED = {"stacked_slave": "{component}_{pol}_slv{index}_{date}", "stacked_ifg": "{component}_ifg_{pol}_{of}_{date}"}


def _pieces(form: str) -> list[str]:
    return re.split(r"\{(\w+)\}", form)  # literal, part, literal, part, ..., literal


def _pattern(form: str) -> str:
    """The form as a regular expression; ``again`` repeats ``of``."""
    held = _pieces(form)[1::2]
    part = lambda p: f"\\{held.index('of') + 1}" if p == "again" else f"({PARTS[p]})"
    return "^" + "".join(re.escape(p) if i % 2 == 0 else part(p) for i, p in enumerate(_pieces(form))) + "$"


def parse_names(inventory: DataFrame) -> DataFrame:
    """Adds ``form`` and its parts ``component``, ``pol``, ``date``, ``of`` (the other date) and ``index``; NULLs where no form fits."""
    name = F.col("band_name")
    form = F.coalesce(*[F.when(name.rlike(_pattern(text)), label) for label, text in FORMS.items()])
    found = {}
    for part in ("component", "pol", "date", "of", "index"):
        places = [(_pattern(text), _pieces(text)[1::2].index(part) + 1) for text in FORMS.values() if part in _pieces(text)]
        found[part] = F.coalesce(*[F.nullif(F.regexp_extract(name, pattern, at), F.lit("")) for pattern, at in places])
    return inventory.withColumns({"form": form} | found)


def final_name() -> Column:
    """The name of a parsed band in a final product."""
    out = F.col("band_name")
    for label, text in RENAMED.items():
        out = F.when(F.col("form") == label, F.concat(*[F.lit(p) if i % 2 == 0 else F.col(p) for i, p in enumerate(_pieces(text))])).otherwise(out)
    return out


def select_export(inventory: DataFrame, kind: str, pol: str = "VV", stack_input: bool = False) -> DataFrame:
    """Bands that leave a product: pairs in one polarisation and, of interferograms, the ancillary bands.

    ``stack_input``: those that enter a final stack: slaves only, and of interferograms no ancillary bands; a product
    without interferogram bands gives all pairs that are not the master's.
    """
    name = F.col("band_name")
    ours, pair, wave = name.contains(f"_{pol}_"), name.rlike("^[iq]_"), name.rlike("^[iq]_ifg_")
    if kind == "coreg":
        return inventory.where(pair & ours & (name.contains("_slv") if stack_input else F.lit(True)))
    if kind != "ifg":
        raise ValueError(f"kind is coreg or ifg, not {kind}")
    if not stack_input:
        return inventory.where((wave & ours) | name.isin(*ANCILLARY))
    some = F.coalesce(F.bool_or(wave & ours).over(Window.partitionBy("product_id")), F.lit(False))
    return inventory.withColumn("_some", some).where(ours & F.when(F.col("_some"), wave).otherwise(pair & ~name.contains("_mst_"))).drop("_some")


def require_selected(selected: DataFrame, inventory: DataFrame) -> DataFrame:
    """The selection, or ValueError naming products of which nothing was selected."""
    bare = inventory.select("product_id").distinct().join(selected.select("product_id"), "product_id", "left_anti").orderBy("product_id").limit(5).collect()
    if bare:
        raise ValueError(f"no band to export in {[r.product_id for r in bare]}")
    return selected


def _dated(inventory: DataFrame, expected: DataFrame) -> DataFrame:
    """Parsed bands with ``known``: whether the date is expected in the band's role; and ``of_known``, of the other date."""
    own = expected.select("product_id", F.col("token").alias("date"), F.col("master").alias("_is"))
    other = expected.where("master").select("product_id", F.col("token").alias("_master"))
    role = F.col("form") == "master"
    return parse_names(inventory).join(own, ["product_id", "date"], "left").join(other, "product_id", "left").withColumns({"known": F.coalesce(F.col("_is") == role, F.lit(False)), "of_known": F.coalesce(F.col("of") == F.col("_master"), F.lit(False))}).drop("_is", "_master")


def select_final(inventory: DataFrame, expected: DataFrame, pol: str = "VV") -> DataFrame:
    """``(product_id, band_name, final_name)``: the first band of each expected date and component, plain or stacked."""
    fits = F.col("form").isin("master", "slave", "stacked_slave") & (F.col("pol") == pol) & F.col("known")
    order = Window.partitionBy("product_id", "date", "component").orderBy("position", "band_name")
    first = _dated(inventory, expected).where(fits).withColumn("_rank", F.row_number().over(order)).where("_rank = 1")
    return first.select("product_id", "band_name", final_name().alias("final_name"))


def missing_pairs(found: DataFrame, expected: DataFrame) -> DataFrame:
    """``(product_id, problem, detail)``: expected dates for which ``found`` (product_id, date, component) lacks i or q."""
    have = found.groupBy("product_id", F.col("date").alias("token")).agg(F.count_distinct("component").alias("k"))
    return expected.join(have, ["product_id", "token"], "left").where(F.coalesce("k", F.lit(0)) < 2).select("product_id", F.lit("pair").alias("problem"), F.col("token").alias("detail"))


def require_pairs(selected: DataFrame, expected: DataFrame) -> DataFrame:
    """The final selection, or ValueError naming dates without a whole pair."""
    lacking = missing_pairs(parse_names(selected.select("product_id", "band_name")), expected).orderBy("product_id", "detail").limit(5).collect()
    if lacking:
        raise ValueError(f"no whole pair for {[(r.product_id, r.detail) for r in lacking]}")
    return selected


def audit_coreg(inventory: DataFrame, expected: DataFrame, pol: str = "VV") -> DataFrame:
    """``(product_id, problem, detail)`` of final coregistered stacks.

    A band is no pair's (``band``), of no final form (``form``), of another polarisation (``pol``) or date (``date``), or
    repeats one before it (``repeat``); an expected date lacks its pair (``pair``); a product has not 2 (1 + n) bands
    (``count``) for n dates besides the master's.
    """
    held = _dated(inventory, expected)
    final = F.coalesce(F.col("form").isin("master", "slave"), F.lit(False))
    judged = held.withColumn("problem", F.when(~F.col("band_name").rlike("^[iq]_"), "band").when(~final, "form").when(F.col("pol") != pol, "pol").when(~F.col("known"), "date"))
    counts = inventory.groupBy("product_id").agg(F.count("*").alias("n"))
    wanted = expected.groupBy("product_id").agg((2 * F.count_distinct("token")).alias("want"))
    wrong = wanted.join(counts, "product_id", "left").where(F.coalesce("n", F.lit(0)) != F.col("want"))
    return _findings(judged, expected).unionByName(wrong.select("product_id", F.lit("count").alias("problem"), F.coalesce("n", F.lit(0)).cast("string").alias("detail")))


def audit_ifg(inventory: DataFrame, expected: DataFrame, pol: str = "VV") -> DataFrame:
    """``(product_id, problem, detail)`` of final interferogram products.

    As ``audit_coreg``, for pairs of dates; bands of other forms are left alone, there is no ``count``, the first date must be the
    master's (``master``), and each ancillary band must be there once (``ancillary``).
    """
    held = _dated(inventory, expected).where("form = 'ifg'")
    judged = held.withColumn("problem", F.when(F.col("pol") != pol, "pol").when(~F.col("of_known"), "master").when(~F.col("known"), "date"))
    each = expected.select("product_id").distinct().withColumn("band_name", F.explode(F.array(*map(F.lit, ANCILLARY))))
    have = inventory.where(F.col("band_name").isin(*ANCILLARY)).groupBy("product_id", "band_name").agg(F.count("*").alias("n"))
    odd = each.join(have, ["product_id", "band_name"], "left").where(F.coalesce("n", F.lit(0)) != 1)
    return _findings(judged, expected.where("NOT master")).unionByName(odd.select("product_id", F.lit("ancillary").alias("problem"), F.col("band_name").alias("detail")))


def _findings(judged: DataFrame, expected: DataFrame) -> DataFrame:
    """Faulty bands, repeats among the others, and dates without a pair."""
    order = Window.partitionBy("product_id", "date", "component").orderBy("position", "band_name")
    sound = judged.where("problem IS NULL").withColumn("_rank", F.row_number().over(order))
    faulty = judged.where("problem IS NOT NULL").select("product_id", "problem", F.col("band_name").alias("detail"))
    repeats = sound.where("_rank > 1").select("product_id", F.lit("repeat").alias("problem"), F.col("band_name").alias("detail"))
    return faulty.unionByName(repeats).unionByName(missing_pairs(sound, expected))
