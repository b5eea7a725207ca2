"""Mixing sources to target weights: water-filled targets, whole copies, then Pareto order sampling.

Every source gets a target of words in proportion to its weight, at most ``max_copies`` times its size;
what a full source can't take is reshared by weight.  A document's expected number of copies is its
source's ratio of target to size (times the document's own weight, relative to the source's mean).  The
whole part of it is allocated outright; the fraction is an inclusion probability p, and documents are
ranked by the random odds over the inclusion odds, u/(1-u) / (p/(1-p)).  One more copy each goes to the
lowest ranks until the source's target is met.

No source is sorted in one task.  Ranks fall into coarse and fine bins; sizes are summed by (source, bin),
first over coarse bins, then over the fine ones where a source's target falls, and only the documents of
that fine bin are ordered exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changegrid.sources.staging import stage

#: Bins of ranks, and how many of them make a coarse bin.
BINS, FINE = 65536, 256
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 if null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float, max_copies: float = 2.0) -> DataFrame:
    """Adds ``target`` to ``(source, source_size, weight)``.

    ``share`` times the sum of sizes is dealt by weight; no target is above ``max_copies`` times its
    source's size, and the excess goes to the others by weight until none is above.  Rounds of two sums
    over the sources' table; the driver sees only the sums.  Weights must be positive; sources of size 0
    have target 0.
    """
    cap = F.col("source_size") * F.lit(float(max_copies))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)) * F.lit(float(share))).first()[0]
    level, full = None, -1
    while True:
        over = F.lit(False) if level is None else cap <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count(F.when(over, 1)).alias("full"),
        ).first()
        if row.full == full or not row.weight:
            break
        full, level = row.full, (total - row.taken) / row.weight
    reached = F.lit(0.0) if level is None else F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.least(cap, reached).cast("double"))


def _cut(bins: DataFrame, room: DataFrame, beyond: int) -> DataFrame:
    """``(source, last, room, before)``: the first bin whose running sum reaches the room, and the sum before it.

    ``bins``: ``(source, at, extra)``; ``room``: ``(source, room, before)``.  A source whose bins do not
    fill its room, or that has none, gets ``beyond`` as its last.
    """
    named = room.select(F.col("source").alias("r_source"), "room", "before")
    upto = Window.partitionBy("r_source").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = named.join(bins, F.col("r_source").eqNullSafe(F.col("source")), "left").withColumn("upto", F.col("before") + F.sum(F.coalesce("extra", F.lit(0))).over(upto))
    reached = F.col("upto") >= F.col("room")
    out = both.groupBy(F.col("r_source").alias("source")).agg(
        F.coalesce(F.min(F.when(reached, F.col("at"))), F.lit(beyond)).alias("last"),
        F.first("room").alias("room"),
        F.coalesce(F.max(F.when(~reached, F.col("upto"))), F.first("before")).alias("before"),
    )
    return stage(out, "mix-cut")


def mix(docs: DataFrame, weights: DataFrame, share: float, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_copies: int = 2, doc_weight: Column | None = None, seed: int = 0) -> DataFrame:
    """``(id, source, size, source_size, target, copies, taken)`` for every row.

    ``weights``: ``(source, weight)``, one positive weight for every source of ``docs`` (null a source
    like others).  ``size`` counts words (null text: 0); ``taken`` is ``copies * size`` and at most
    ``max_copies * size``.  ``doc_weight`` raises or lowers a document's expected copies; without it they
    are equal within a source.  Random numbers are hashes of the id and ``seed``, so reruns agree; rows of
    equal id, source and size tie and are ordered arbitrarily, with equal effect.  An empty table gives an
    empty result; extra columns, whatever their names, are ignored; only the count of words of a long text moves on.  A source's taken words miss its target by about half of one document at most, as long
    as ``doc_weight`` leaves enough documents below ``max_copies``.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), (F.lit(1.0) if doc_weight is None else doc_weight.cast("double")).alias("w"))
    rows = stage(rows, "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("w")).alias("weighted"))
    named = weights.select(F.col("source").alias("w_source"), "weight")
    plan = sizes.join(named, F.col("source").eqNullSafe(F.col("w_source"))).select("source", "source_size", "weighted", F.col("weight").cast("double").alias("weight"))
    plan = stage(targets(stage(plan, "mix-sources"), share, max_copies), "mix-targets")

    named = plan.select(F.col("source").alias("p_source"), "source_size", "target", F.when(F.col("weighted") > 0, F.col("target") / F.col("weighted")).otherwise(0.0).alias("rate"))
    expected = F.least(F.col("rate") * F.col("w"), F.lit(float(max_copies)))
    unit = (F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    p = F.least(F.greatest(F.col("expected") - F.col("whole"), F.lit(1e-12)), F.lit(1 - 1e-12))
    rank = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    ranked = (
        rows.join(named, F.col("source").eqNullSafe(F.col("p_source")))
        .select("id", "source", "size", "source_size", "target", expected.alias("expected"), unit.alias("u"))
        .withColumn("whole", F.floor("expected"))
        .withColumn("rank", F.when((F.col("whole") < max_copies) & (F.col("size") > 0), rank))
        # rank / (1 + rank) lies in 0..1 and keeps the order
        .withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS).cast("int"))
        .drop("expected", "u")
    )
    # the coarse bin of each source's cut, then the fine bin in it: two short tables a source
    given = stage(ranked.groupBy("source").agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("room")), "mix-room")
    coarse = ranked.where(F.col("bin").isNotNull()).groupBy("source", F.floor(F.col("bin") / FINE).cast("int").alias("at")).agg(F.sum("size").alias("extra"))
    first = _cut(coarse, given.withColumn("before", F.lit(0).cast("long")), BINS // FINE)
    held = first.select(F.col("source").alias("h_source"), F.col("last").alias("h_last"))
    fine = ranked.join(held, F.col("source").eqNullSafe(F.col("h_source")) & (F.floor(F.col("bin") / FINE) == F.col("h_last"))).groupBy("source", F.col("bin").alias("at")).agg(F.sum("size").alias("extra"))
    cut = _cut(fine, first.select("source", "room", "before"), BINS).select(F.col("source").alias("c_source"), "last", "room", "before")
    near = ranked.join(cut, F.col("source").eqNullSafe(F.col("c_source")), "left")
    at_cut = F.coalesce(F.col("bin") == F.col("last"), F.lit(False))
    order = Window.partitionBy("source").orderBy("rank", "id", "size")
    last = near.where(at_cut).withColumn("total", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # the document that crosses the target is taken if that comes nearer
    last = last.withColumn("more", (F.col("before") + F.col("total") - F.col("size") / 2.0 < F.col("room")).cast("long")).drop("total")
    rest = near.where(~at_cut).withColumn("more", F.coalesce(F.col("bin") < F.col("last"), F.lit(False)).cast("long"))
    both = rest.unionByName(last)
    copies = (F.col("whole") + F.col("more")).cast("long")
    return both.select("id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def repeating_weights(docs: DataFrame, source_col: str = "source", cycle: tuple[float, ...] = (3.0, 1.0, 2.0)) -> DataFrame:
    """``(source, weight)``: weights repeat along the sources by code point, null last.

    Numbering uses one task over the distinct sources (names only).
    """
    named = docs.select(F.col(source_col).alias("source")).distinct()
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return named.select("source", F.element_at(F.array(*[F.lit(float(x)) for x in cycle]), (at % len(cycle) + 1).cast("int")).alias("weight"))


def op5_pareto_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed = mix(docs, repeating_weights(docs), share=1.5)
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies")
