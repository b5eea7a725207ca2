"""Places along closed chains: distributed list ranking.

Chains are cut at bucket borders, so a ring that crosses many tiles is never one task: buckets link their own stretches,
and the stretches are ranked by pointer jumping, each round of which doubles the part of its ring that a stretch has seen.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changegrid.sources.staging import stage


def _stretches(pdf: pd.DataFrame) -> pd.DataFrame:
    """The links of one bucket with the first of their stretch (``seg``) and their place in it."""
    pdf = pdf.sort_values("id", kind="stable").reset_index(drop=True)
    ids, follows = pdf["id"].to_numpy(), pdf["next"].to_numpy()
    at = np.minimum(np.searchsorted(ids, follows), len(ids) - 1)
    inside = ids[at] == follows
    led = np.zeros(len(ids), bool)
    led[at[inside]] = True
    succ, seg, place = np.where(inside, at, -1).tolist(), np.full(len(ids), -1), np.zeros(len(ids), np.int64)
    for start in [*np.flatnonzero(~led).tolist(), *range(len(ids))]:  # what is left after the open ones are whole rings
        i, k = start, 0
        while i >= 0 and seg[i] < 0:
            seg[i], place[i], i, k = start, k, succ[i], k + 1
    return pdf.assign(seg=ids[seg], place=place)[["id", "next", "low", "seg", "place"]]


def rank_cycles(links: DataFrame, buckets: list[str]) -> DataFrame:
    """``(id, ring, place, n)``: each link's ring, named by its head's id, its place from the head and the ring's size.

    ``links``: ``(id, next, low, *buckets)``, longs; every id is the ``next`` of exactly one link.  A ring's head is the
    link with the smallest ``(low, id)``.  A bucket's links go through one task, so buckets must be of bounded size.
    """
    own = stage(links.groupBy(*buckets).applyInPandas(_stretches, "id long, next long, low long, seg long, place long"), "chain-stretches")
    least = F.min(F.struct("low", "id", F.col("place").alias("hops")))
    segs = own.groupBy("seg").agg(F.max_by("next", "place").alias("ptr"), F.count("*").alias("span"), least.alias("least"))
    segs = stage(segs.select("seg", "ptr", "span", F.col("span").alias("size"), F.struct("least.low", "least.id").alias("low"), F.col("least.hops").alias("hops")), "chain-segments")
    closed, open_ = segs.where("ptr = seg"), segs.where("ptr != seg")
    while True:
        then = open_.select(F.col("seg").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("span").alias("span2"), F.col("low").alias("low2"), F.col("hops").alias("hops2"))
        less = F.col("low2") < F.col("low")
        met = open_.join(then, "ptr").select(
            "seg", F.col("ptr2").alias("ptr"), (F.col("span") + F.col("span2")).alias("span"), "size", F.least("low", "low2").alias("low"),
            F.when(less, F.col("span") + F.col("hops2")).otherwise(F.col("hops")).alias("hops"), less.alias("changed"),
        )
        met = stage(met, "chain-round")
        open_ = met.drop("changed")
        if met.where("changed").isEmpty():  # a head that some stretch has not seen is news to one in every round
            break
    found = closed.unionByName(open_).select("seg", "size", F.col("low.id").alias("ring"), "hops")
    sizes = found.groupBy("ring").agg(F.sum("size").alias("n"))
    both = own.select("id", "seg", "place").join(found.select("seg", "ring", "hops"), "seg").join(sizes, "ring")
    return both.select("id", "ring", F.pmod(F.col("place") - F.col("hops"), F.col("n")).alias("place"), "n")
