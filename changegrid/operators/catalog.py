"""Scene catalogues: filters, windows, stacks, orbit files, band inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changegrid.operators.cells import near_pairs
from changegrid.operators.polygons import polygons_meet
from changegrid.operators.spatial import rect_ring
from changegrid.sources.staging import stage


def normalize(token: Column) -> Column:
    """Lower case without - and _; NULL becomes ''."""
    return F.lower(F.translate(F.coalesce(token, F.lit("")), "-_", ""))


def first_of(properties: Column, *names: str) -> Column:
    """First property among ``names`` that is there and not empty."""
    return F.coalesce(*[F.nullif(F.try_element_at(properties, F.lit(n)), F.lit("")) for n in names])


def meets_area(scenes: DataFrame, areas: DataFrame) -> DataFrame:
    """Scenes that meet any of the areas, borders too, once each.

    Either side has polygons (``rings``) or boxes (``x0, y0, x1, y1``, degrees).  Boxes meet in cells of their own
    size; where there are rings, their edges do, or one shape holds the other.
    """
    if "rings" not in areas.columns and "rings" not in scenes.columns:
        box = ("x0", "y0", "x1", "y1")
        met = near_pairs(scenes.select("scene_id", *box), areas.select(*box), CELL).select(F.col("pscene_id").alias("_scene")).distinct()
    else:
        shape = lambda df: df if "rings" in df.columns else df.withColumn("rings", F.array(rect_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])))
        held = stage(stage(shape(areas).select("rings"), "areas").withColumn("_area", F.monotonically_increasing_id()), "area-ids")
        own = stage(shape(scenes).select(F.col("scene_id").alias("_scene"), "rings"), "scene-shapes")
        met = polygons_meet(own, held, "_scene", "_area", CELL).select("_scene").distinct()
    return scenes.join(met, F.col("scene_id") == F.col("_scene"), "left_semi")


#: Degrees of a cell in which boxes of scenes and areas meet.
CELL = 5.0


def polarization_text(value: Column) -> Column:
    """Channels as one text: a text stays as it is; a list, also one written as JSON, is sorted and joined by +."""
    listed = F.from_json(value, "array<string>")
    return F.when(F.ltrim(value).startswith("["), F.array_join(F.array_sort(listed), "+")).otherwise(F.coalesce(value, F.lit("")))


def acquisition_times(properties: Column, moment: Column) -> dict[str, Column]:
    """Start, stop and date of an acquisition: start and end of the properties, else the item's moment; ISO texts, Z as UTC."""
    start = F.coalesce(F.nullif(F.try_element_at(properties, F.lit("start_datetime")), F.lit("")), moment)
    stop = F.coalesce(F.nullif(F.try_element_at(properties, F.lit("end_datetime")), F.lit("")), moment)
    return {"acquisition_start": start, "acquisition_stop": stop, "acquisition_date": F.to_date(F.to_timestamp(start))}


#: Names that catalogues use for one property, in order of preference.
ALIASES = {
    "direction": ("sat:orbit_state", "orbit_state", "s1:orbit_state"),
    "relative_orbit": ("sat:relative_orbit", "relativeOrbitNumber"),
    "polarization": ("sar:polarizations", "polarisationChannels"),
    "product_type": ("product:type", "productType"),
    "level": ("processing:level", "processing_level"),
    "mode": ("sar:instrument_mode", "sensorMode"),
}


def scene_records(items: DataFrame) -> DataFrame:
    """Flat scenes ``(scene_id, platform, direction, relative_orbit, ...)`` of items ``(id, datetime, properties map)``."""
    held = {name: first_of(F.col("properties"), *keys) for name, keys in ALIASES.items()}
    held |= {"direction": F.lower(held["direction"]), "relative_orbit": held["relative_orbit"].try_cast("int"), "polarization": polarization_text(held["polarization"])}
    times = acquisition_times(F.col("properties"), F.col("datetime"))
    platform = F.coalesce(F.try_element_at(F.col("properties"), F.lit("platform")), F.lit(""))
    name = F.coalesce(F.try_element_at(F.col("properties"), F.lit("title")), F.col("id"))
    return items.select(F.col("id").alias("scene_id"), name.alias("product_name"), platform.alias("platform"), *[v.alias(k) for k, v in (held | times).items()], times["acquisition_date"].alias("day"))


def filter_radar(scenes: DataFrame, platform: str = "", orbit: str | None = None, polarizations: tuple[str, ...] = (), start=None, end=None, mode: str | None = None, areas: DataFrame | None = None) -> DataFrame:
    """Radar scenes of a platform and with needed channels (both normalised), an orbit direction, instrument mode,
    inclusive dates and, if areas are given, a box that meets one."""
    out = scenes
    if start is not None:
        out = out.where(F.col("day").between(F.lit(start), F.lit(end)))
    if mode:
        out = out.where(F.col("mode") == mode)
    if platform:
        out = out.where(normalize(F.col("platform")) == normalize(F.lit(platform)))
    if orbit:
        out = out.where(F.col("direction") == orbit)
    if polarizations:
        held = F.transform(F.split("polarization", r"\+"), normalize)
        out = out.where(F.size(F.array_except(F.array(*[normalize(F.lit(p)) for p in polarizations]), held)) == 0)
    return out if areas is None else meets_area(out, areas)


def filter_optical(scenes: DataFrame, max_cloud: float = 80.0, start=None, end=None, areas: DataFrame | None = None) -> DataFrame:
    """Optical scenes strictly below a cloud cover, in inclusive dates and, if areas are given, meeting one."""
    out = scenes.where(F.col("cloud_cover") < max_cloud)
    out = out if start is None else out.where(F.col("day").between(F.lit(start), F.lit(end)))
    return out if areas is None else meets_area(out, areas)


def in_windows(scenes: DataFrame, windows: DataFrame) -> DataFrame:
    """Scenes by the period and phase whose inclusive window holds their date.

    Windows are cut into their months, so it is an equi-join on the month with an exact test behind.
    """
    month = lambda d: F.date_format(d, "yyyyMM")
    cut = windows.withColumn("_month", F.explode(F.transform(F.sequence(F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month")), month)))
    return scenes.withColumn("_month", month(F.col("day"))).join(cut, "_month").where(F.col("day").between(F.col("start"), F.col("end"))).drop("_month")


def stack_scenes(scenes: DataFrame, stacks: DataFrame, start=None, end=None) -> DataFrame:
    """Scenes of each configured stack.

    Direction and orbit number are there and equal; the mode is IW; the level is missing or L1; the product type is missing or
    names SLC; a stack on VV or VH needs that channel, any other polarisation is not tested; dates are inclusive.
    """
    out = scenes.where("mode = 'IW' AND coalesce(level, 'L1') = 'L1' AND coalesce(contains(product_type, 'SLC'), true)")
    if start is not None:
        out = out.where(F.col("day").between(F.lit(start), F.lit(end)))
    asked = stacks.withColumnRenamed("polarization", "_wanted")
    met = out.withColumn("direction", F.lower("direction")).join(asked, ["direction", "relative_orbit"])
    return met.where("_wanted NOT IN ('VV', 'VH') OR contains(polarization, _wanted)").drop("_wanted")


def require_scenes(scenes: DataFrame, stacks: DataFrame, least: int) -> DataFrame:
    """The scenes, or ValueError naming stacks with fewer than ``least``."""
    counts = stacks.select("stack_id").join(scenes.groupBy("stack_id").agg(F.count("*").alias("n")), "stack_id", "left")
    short = counts.where(F.coalesce("n", F.lit(0)) < least).orderBy("stack_id").limit(5).collect()
    if short:
        raise ValueError(f"fewer than {least} scenes: {[(r.stack_id, r.n or 0) for r in short]}")
    return scenes


def centred_window(scenes: DataFrame, limit: int | None, least: int, masters: DataFrame | None = None) -> DataFrame:
    """At most ``limit`` scenes of each stack (None: all): around its master, else the earliest; stacks under ``least`` go.

    ``masters``: ``(stack_id, master_day)``; stacks without one take their earliest scenes.  Where a short
    stack is an error, ``require_scenes`` comes first.
    """
    order = Window.partitionBy("stack_id").orderBy("day", "scene_id")
    out = scenes.withColumn("i", F.row_number().over(order) - 1).withColumn("n", F.count("*").over(Window.partitionBy("stack_id"))).where(F.col("n") >= least)
    if limit is None:
        return out.drop("i", "n")
    if masters is None:
        start = F.lit(0)
    else:
        out = out.join(masters, "stack_id", "left")
        at = F.min(F.when(F.col("day") == F.col("master_day"), F.col("i"))).over(Window.partitionBy("stack_id"))
        out = out.withColumn("at", at)
        start = F.coalesce(F.greatest(F.lit(0), F.least(F.col("at") - limit // 2, F.col("n") - limit)), F.lit(0))
    return out.where(F.col("i").between(start, start + limit - 1)).drop("i", "n", "at", "master_day")


def date_chunks(windows: DataFrame, days: int = 45) -> DataFrame:
    """Inclusive windows cut into chunks of at most ``days`` days."""
    starts = F.explode(F.sequence("start", "end", F.expr(f"interval {days} days")))
    return windows.withColumn("chunk_start", starts).withColumn("chunk_end", F.least(F.date_add("chunk_start", days - 1), F.col("end")))


def stack_summary(scenes: DataFrame) -> DataFrame:
    return scenes.groupBy("stack_id").agg(F.count("*").alias("scene_count"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.min_by("scene_id", F.struct("day", "scene_id")).alias("first_scene"))


def secondaries(scenes: DataFrame, masters: DataFrame) -> DataFrame:
    """Scenes of each stack other than its master."""
    return scenes.join(masters, "stack_id").where(F.col("day") != F.col("master_day"))


def require_masters(scenes: DataFrame, masters: DataFrame, least: int = 2) -> DataFrame:
    """The secondaries, or ValueError where a master is absent or has fewer than ``least`` of them."""
    own = masters.join(scenes.select("stack_id", "day"), "stack_id", "left")
    same = F.col("day") == F.col("master_day")
    counts = own.groupBy("stack_id").agg(F.count_if(same).alias("masters"), F.count_if(~same).alias("others"))
    short = counts.where((F.col("masters") == 0) | (F.col("others") < least)).orderBy("stack_id").limit(5).collect()
    if short:
        raise ValueError(f"absent master or fewer than {least} secondaries: {[r.stack_id for r in short]}")
    return secondaries(scenes, masters)


def platform_id(platform: Column) -> Column:
    token = normalize(platform)
    return F.when(token.endswith("1a"), "S1A").when(token.endswith("1b"), "S1B").otherwise(F.upper(token))


#: Fixed format of orbit file names.
ORBIT_NAME = r"^(S1[AB])_OPER_AUX_(POEORB|RESORB)_OPOD_\d{8}T\d{6}_V(\d{8}T\d{6})_(\d{8}T\d{6})\.EOF"


def parse_orbit_files(files: DataFrame) -> DataFrame:
    """``(name, platform, kind, valid_from, valid_to)`` of files whose names follow ORBIT_NAME."""
    found = [F.regexp_extract("name", ORBIT_NAME, i) for i in range(1, 5)]
    stamp = [F.to_timestamp(F.nullif(x, F.lit("")), "yyyyMMdd'T'HHmmss") for x in found[2:]]
    return files.where(F.col("name").rlike(ORBIT_NAME)).select("name", found[0].alias("orbit_platform"), found[1].alias("kind"), stamp[0].alias("valid_from"), stamp[1].alias("valid_to"))


def match_orbits(scenes: DataFrame, orbits: DataFrame, kind: str = "POEORB", bucket_days: int = 7) -> DataFrame:
    """For each scene the lowest-named orbit file of its platform whose validity holds the scene's time.

    An interval join: validities are cut into buckets of ``bucket_days``, so it is an equi-join on platform
    and bucket; a scene lies in one bucket.  Scenes without a file keep NULL.
    """
    step = bucket_days * 86400
    bucket = lambda t: F.floor(F.unix_timestamp(t) / step)
    cut = orbits.where(F.col("kind") == kind).withColumn("bucket", F.explode(F.sequence(bucket("valid_from"), bucket("valid_to"))))
    own = scenes.withColumn("bucket", bucket(F.col("day").cast("timestamp"))).withColumn("orbit_platform", platform_id(F.col("platform")))
    hit = own.join(cut, ["orbit_platform", "bucket"]).where(F.col("day").cast("timestamp").between(F.col("valid_from"), F.col("valid_to")))
    best = hit.groupBy("scene_id").agg(F.min("name").alias("orbit_file"))
    return scenes.join(best, "scene_id", "left")


def object_path(href: Column) -> Column:
    """/bucket/key of an s3 link: up to the first part that ends in .SAFE, else without a final manifest.safe."""
    path = F.rtrim(F.regexp_replace(href, r"^s3://", "/"), F.lit("/"))
    cut = F.regexp_extract(path, r"^((?:/[^/]*)*?/[^/]*\.SAFE)(?:/|$)", 1)
    plain = F.regexp_replace(path, r"(?i)/manifest\.safe$", "")
    return F.when(href.startswith("s3://"), F.when(cut != "", cut).otherwise(plain))


#: Fixed format of the names of radar scenes, and where the archive keeps them.
PRODUCT_NAME = r"^S1[A-Z]_"
ARCHIVE = "/eodata/Sentinel-1/SAR/SLC/"


def scene_path(assets: Column, preferred: tuple[str, ...], product_name: Column, day: Column) -> Column:
    """The object path of a scene: of the first asset that has an s3 link, preferred ones first, else made of name and date.

    An asset's link is its own, else that of its alternates ``s3`` and ``s3+https``.  NULL where there is none and the name is
    not a radar scene's.
    """

    def link(name: Column) -> Column:
        asset = F.try_element_at(assets, name)
        held = [asset["href"], *[F.try_element_at(asset["alternate"], F.lit(k))["href"] for k in ("s3", "s3+https")]]
        return F.coalesce(*[F.when(h.startswith("s3://"), h) for h in held])

    names = F.array_distinct(F.concat(F.array(*map(F.lit, (*preferred, "safe_manifest"))), F.map_keys(assets)))
    found = F.filter(F.transform(names, lambda n: F.nullif(object_path(link(n)), F.lit(""))), lambda p: p.isNotNull())
    safe = F.when(product_name.endswith(".SAFE"), product_name).otherwise(F.concat(product_name, F.lit(".SAFE")))
    derived = F.when(product_name.rlike(PRODUCT_NAME), F.concat(F.lit(ARCHIVE), F.date_format(day, "yyyy/MM/dd"), F.lit("/"), safe))
    return F.coalesce(F.get(found, F.lit(0)), derived)


def product_uuid(href: Column) -> Column:
    return F.nullif(F.regexp_extract(href, r"Products\(([0-9A-Za-z-]+)\)/\$value", 1), F.lit(""))


#: Fixed format of stacked band names: component, polarisation, role, date.
BAND_NAME = r"^([iq])_(VV|VH)_(mst|slv)\d*_(\d{2}[A-Z][a-z]{2}\d{4})$"


def parse_bands(inventory: DataFrame) -> DataFrame:
    """Component, polarisation, role and date token of band names; NULLs where the name does not follow BAND_NAME."""
    parts = {n: F.nullif(F.regexp_extract("band_name", BAND_NAME, i), F.lit("")) for i, n in enumerate(("component", "pol", "role", "token"), 1)}
    return inventory.withColumns(parts)


def audit_bands(inventory: DataFrame) -> DataFrame:
    """``(product_id, problem, detail)``: names out of format, repeated bands, and dates that lack i or q."""
    bands = parse_bands(inventory)
    odd = bands.where("component IS NULL").select("product_id", F.lit("unexpected").alias("problem"), F.col("band_name").alias("detail"))
    each = bands.where("component IS NOT NULL").groupBy("product_id", "token", "pol", "component").agg(F.count("*").alias("n"))
    twice = each.where("n > 1").select("product_id", F.lit("duplicate").alias("problem"), F.concat_ws("_", "component", "pol", "token").alias("detail"))
    lone = each.groupBy("product_id", "token", "pol").agg(F.collect_set("component").alias("have")).where("size(have) < 2")
    missing = lone.select("product_id", F.lit("missing").alias("problem"), F.concat_ws("_", F.when(F.array_contains("have", "i"), "q").otherwise("i"), "pol", "token").alias("detail"))
    return odd.unionByName(twice).unionByName(missing)


def select_bands(inventory: DataFrame, pol: str = "VV") -> DataFrame:
    """The first band (by name) of each product, date and component in one polarisation, with its canonical name."""
    order = Window.partitionBy("product_id", "token", "component").orderBy("band_name")
    first = parse_bands(inventory).where(F.col("pol") == pol).withColumn("rank", F.row_number().over(order)).where("rank = 1")
    return first.select("product_id", "band_name", F.concat_ws("_", "component", "pol", "token").alias("canonical"))


def pair_pivot(products: DataFrame, swaths: list[str]) -> DataFrame:
    """One row a date, one column a swath: the least product of each, NULL where missing."""
    return products.groupBy("day").pivot("swath", swaths).agg(F.min("product"))


def probe_stacks(scenes: DataFrame, stacks: DataFrame) -> DataFrame:
    """For each configured stack its first matching scene, NULLs where nothing matches."""
    first = stack_scenes(scenes, stacks).groupBy("stack_id").agg(F.min(F.struct("day", "scene_id")).alias("first"))
    return stacks.join(first, "stack_id", "left").select("stack_id", F.col("first.scene_id").alias("scene_id"), F.col("first.day").alias("day"))


def missing_dates(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Days of each stack that are expected but not there."""
    return expected.select("stack_id", "day").distinct().join(actual.select("stack_id", "day"), ["stack_id", "day"], "left_anti")
