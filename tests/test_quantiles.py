"""Medians of deep groups against the built-in ones."""

from pyspark.sql import functions as F

from changegrid.operators import quantiles as Q
from changegrid.operators import raster as R


def test_medians_of_deep_groups(spark, monkeypatch):
    """A hot key, a null key, equal values, extremes, nulls, empty groups; even and odd numbers of values."""
    rows = spark.range(0, 60000, 1, 6).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 1 WHEN id % 30 = 0 THEN NULL ELSE 2 + id % 300 END AS g", "pmod(xxhash64(id), 1000003) / 7.0D AS a",
        "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 7 = 0 THEN 1e300 WHEN id % 11 = 0 THEN -1e300 ELSE pow(id % 97, 9) END AS b", "CASE WHEN id % 3 = 0 THEN 4.5D END AS c",
    )
    more = [F.count("*").alias("n"), F.count("b").alias("nb")]
    values = {"a": F.col("a"), "b": F.col("b") / 4, "c": F.col("c")}
    want = {tuple(r) for r in Q.medians(rows, ["g"], values, more, deep=None).collect()}
    monkeypatch.setattr(Q, "SORTED", 100)
    for deep in (0, 500, 10**6):
        assert {tuple(r) for r in Q.medians(rows, ["g"], values, more, deep).collect()} == want
    assert Q.medians(rows.where("a < 0"), ["g"], values, more, 5).count() == 0


def test_one_deep_pixel(spark):
    """A million observations at one pixel, among shallow ones."""
    obs = spark.range(0, 1_000_001, 1, 8).selectExpr("'p' AS period_id", "CASE WHEN id % 2 = 0 THEN 'before' ELSE 'after' END AS phase", "CAST(CASE WHEN id > 999000 THEN id % 9 ELSE 0 END AS INT) AS r", "0 AS c", "pmod(xxhash64(id), 1000003) / 1000003.0D AS vv", "CAST(id % 1000 AS DOUBLE) AS vh")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(R.s1_composite(obs, 10_000)) == key(R.s1_composite(obs))
