"""Exact medians of groups of any depth.

The built-in median keeps the different values of a group in one buffer, which suits pixels of some hundred scenes.  Groups
deeper than ``deep`` are narrowed down instead: values are counted in bins, combined before the shuffle, and only the bin
that holds the median is looked into further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changegrid.sources.staging import stage

#: Values of a group beyond which it is narrowed down; bins of a round; values of a bin that are sorted in one place.
DEEP, BINS, SORTED = 1 << 20, 1024, 1 << 14


def deep_medians(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """``(*keys, name, median)`` of the numeric columns ``values``, nulls left out; groups of any depth, null keys too.

    Each round leaves at most one bin in ``BINS`` of what it looks at, so a few rounds settle any group; equal values
    are one bin of no width.
    """
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("v")) for v in values])).alias("e")
    long = stage(rows.select(F.struct(*keys).alias("g"), each).select("g", "e.name", "e.v").where("v IS NOT NULL"), "median-values")
    own = ["g", "name"]
    span = long.groupBy(*own).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    # the two middle places, from 0; equal for an odd number of values
    which = F.explode(F.array_distinct(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)))).alias("rank")
    open_, found = stage(span.select(*own, "n", "lo", "hi", which), "median-open"), None
    while True:
        settled = open_.where("lo = hi").select(*own, F.col("lo").alias("v"))
        few = open_.where(f"lo < hi AND n <= {SORTED}")
        near = few.withColumnRenamed("rank", "at").join(long, own).where(F.col("v").between(F.col("lo"), F.col("hi")))
        ordered = near.groupBy(*own, "at", "lo", "hi").agg(F.sort_array(F.collect_list("v")).alias("s")).select(*own, F.element_at("s", (F.col("at") + 1).cast("int")).alias("v"))
        done = stage(settled.unionByName(ordered), "median-done")
        found = done if found is None else found.unionByName(done)
        rest = stage(open_.where(f"lo < hi AND n > {SORTED}"), "median-rest")
        if rest.isEmpty():
            break
        bin_ = F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * BINS), F.lit(BINS - 1))
        binned = rest.join(long, own).where(F.col("v").between(F.col("lo"), F.col("hi"))).groupBy(*own, "rank", "lo", "hi", bin_.alias("bin")).agg(F.count("*").alias("k"), F.min("v").alias("lo2"), F.max("v").alias("hi2"))
        upto = F.sum("k").over(Window.partitionBy(*own, "rank", "lo", "hi").orderBy("bin"))
        held = binned.withColumn("upto", upto).where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("k") <= F.col("rank")))
        open_ = stage(held.select(*own, F.col("k").alias("n"), F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), (F.col("rank") - F.col("upto") + F.col("k")).alias("rank")), "median-open")
    return found.groupBy(*own).agg((F.min("v") * 0.5 + F.max("v") * 0.5).alias("median")).select("g.*", "name", "median")


def medians(rows: DataFrame, keys: list[str], values: dict[str, Column], more: list[Column] | None = None, deep: int | None = DEEP) -> DataFrame:
    """``(*keys, *values, *more)``: median of each value and the aggregates ``more`` by group.

    With ``deep``, groups of more rows than that are counted out first; without any, as is the rule, the
    aggregate is a plain one.  None takes every group to be shallow.
    """
    plain = [F.median(v).alias(k) for k, v in values.items()]
    whole = lambda df: df.groupBy(*keys).agg(*plain, *(more or []))
    if deep is None:
        return whole(rows)
    many = stage(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > deep).drop("_n"), "median-deep")
    if many.isEmpty():
        return whole(rows)
    named = many.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    shallow, rest = rows.join(named, same, "left_anti"), rows.join(named, same, "left_semi")
    found = deep_medians(rest.select(*keys, *[v.alias(k) for k, v in values.items()]), keys, list(values))
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == k, F.col("median"))).alias(k) for k in values])
    others = rest.groupBy(*keys).agg(F.count("*").alias("_n"), *(more or [])).select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct("*").alias("_more"))
    wide = others.join(wide, same, "left")
    return whole(shallow).unionByName(wide.select(*[F.col(f"_{k}").alias(k) for k in keys], *values, *[F.col(f"_more.{c}") for c in whole(rows).columns if c not in keys and c not in values]))
