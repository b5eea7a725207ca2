"""Observation tables derived from the given tables, as SQL that Spark and DuckDB both read.

``{lineitem}`` and the like stand for the given tables: Spark gets DataFrames, DuckDB view names.  Rasters are a
strip of 48 columns that takes 48 more rows for every 15,000 order keys, so they grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("lineitem", "orders", "events", "supplier")

CTES = {
    "raw": """
      SELECT CASE WHEN l_linenumber % 2 = 1 THEN 'p1' ELSE 'p2' END AS period_id,
        CASE WHEN CAST(l_shipdate AS DATE) < DATE '1998-06-01' THEN 'before' ELSE 'after' END AS phase,
        CAST(floor(l_orderkey / 15000) * 48 + l_orderkey % 48 AS INT) AS r, CAST(l_partkey % 48 AS INT) AS c, l_discount AS d, l_tax AS t, l_quantity AS q,
        l_suppkey AS s, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT) AS scene
      FROM {lineitem}""",
    "s1_obs": """
      SELECT period_id, phase, r, c, (CAST(0.8 AS DOUBLE) + 2 * d) * (CASE WHEN built THEN 9 ELSE 1 END) AS vv,
        (CAST(0.8 AS DOUBLE) + 2 * t) * (CASE WHEN built THEN CAST(1.6 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END) AS vh
      FROM (SELECT *, phase = 'after' AND (CAST(floor(r / 6) * 7 + floor(c / 6) * 3 AS INT) % 5 < (CASE WHEN period_id = 'p1' THEN 1 ELSE 2 END)
        OR (r * 13 + c * 7) % 97 = 0) AS built FROM raw) b""",
    "s2_obs": """
      SELECT period_id, phase, scene, r, c, CAST(s % 9 AS INT) AS scl, 500 + 10 * q AS blue, 700 + 10 * q AS green, 600 + 10000 * t AS red,
        CASE WHEN s % 17 = 0 THEN NULL ELSE 2500 - 20 * q END AS nir, 1200 + 15000 * d AS swir1 FROM raw""",
    "scenes": """
      SELECT concat('SCN_', CAST(o_orderkey AS VARCHAR(20))) AS scene_id, o_orderkey AS k, CAST(o_orderdate AS DATE) AS day,
        CASE o_orderkey % 3 WHEN 0 THEN 'SENTINEL-1A' WHEN 1 THEN 'sentinel_1a' ELSE 'sentinel-1b' END AS platform,
        CASE WHEN o_custkey % 2 = 0 THEN 'ascending' ELSE 'descending' END AS direction, CAST(o_custkey % 5 AS INT) AS relative_orbit,
        o_totalprice - 100 * floor(o_totalprice / 100) AS cloud_cover,
        CASE o_orderkey % 4 WHEN 0 THEN 'VV+VH' WHEN 1 THEN 'VH+VV' WHEN 2 THEN 'VV' ELSE 'HH' END AS polarization,
        CASE WHEN o_orderkey % 11 = 5 THEN 'EW' ELSE 'IW' END AS mode, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'L2' ELSE 'L1' END AS level,
        CASE o_orderkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'GRD' ELSE 'IW_SLC__1S' END AS product_type,
        CAST(o_orderkey % 340 - 170 AS DOUBLE) AS x0, CAST(o_custkey % 150 - 75 AS DOUBLE) AS y0, CAST(o_orderkey % 340 - 167 AS DOUBLE) AS x1, CAST(o_custkey % 150 - 73 AS DOUBLE) AS y1
      FROM {orders}""",
    # a product is a stack's year: its first day is the master's; g spoils some of its bands
    "band_days": """
      SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY day) - 1 AS n, first_value(token) OVER (PARTITION BY product_id ORDER BY day) AS mst FROM (
        SELECT concat(direction, '_', CAST(relative_orbit AS VARCHAR(5)), '_', CAST(year(day) AS VARCHAR(5))) AS product_id, day, min(k) % 50 AS g,
          concat(lpad(CAST(day(day) AS VARCHAR(2)), 2, '0'), substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * month(day) - 2, 3), CAST(year(day) AS VARCHAR(5))) AS token
        FROM scenes GROUP BY direction, relative_orbit, day) d""",
    "band_rows": """
      SELECT product_id, g, n, c, token, mst, rep, CASE WHEN g = 23 THEN '01Jan1990' ELSE token END AS tok, CASE WHEN g = 11 THEN 'VH' ELSE 'VV' END AS pol,
        CASE WHEN g = 29 THEN '02Jan1990' ELSE mst END AS first, CAST(n + 500 * rep AS VARCHAR(9)) AS num, 8 * n + 2 * rep + (CASE WHEN c = 'q' THEN 1 ELSE 0 END) AS position
      FROM band_days, (VALUES ('i'), ('q')) AS v(c), (VALUES (0), (1)) AS w(rep) WHERE (rep = 0 OR g = 13) AND NOT (g = 7 AND c = 'q')""",
    "coreg_bands": """
      SELECT *, CASE WHEN g = 3 THEN concat('bad_', base) WHEN g = 17 THEN concat(base, '_x') WHEN g = 19 AND n > 0 THEN concat(c, '_VV_slv1_', token, '_slv', num, '_', mst) ELSE base END AS band_name
      FROM (SELECT *, CASE WHEN n = 0 THEN concat(c, '_', pol, '_mst_', tok) ELSE concat(c, '_', pol, '_slv', num, '_', tok) END AS base FROM band_rows) b""",
    "ifg_bands": """
      SELECT product_id, g, n, c, token, mst, rep, position, CASE WHEN g = 19 THEN concat(c, '_ifg_VV_', mst, '_', token, '_slv', num, '_', mst) ELSE concat(c, '_ifg_', pol, '_', first, '_', tok) END AS band_name
      FROM band_rows WHERE n > 0
      UNION ALL SELECT product_id, -1, -1, '', '', mst, k, -1, name FROM band_days, (VALUES (0, 'elevation'), (1, 'orthorectifiedLat'), (2, 'orthorectifiedLon'), (3, 'elevation')) AS v(k, name)
      WHERE n = 0 AND (k = 1 OR (k = 0 AND g % 3 > 0) OR (k = 3 AND g % 3 > 1) OR (k = 2 AND g % 2 = 1))""",
    "psi_points": """
      SELECT CAST(r * 48 + c AS BIGINT) AS point_id, r AS azimuth_index, c AS range_index, avg(CAST(0.8 AS DOUBLE) + d) AS tc_c, avg(CAST(0.8 AS DOUBLE) + t) AS tc_f,
        avg(CAST(0.8 AS DOUBLE) + q / 500) + (CASE WHEN (r + c) % 29 = 0 THEN CAST(0.6 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS tc_b
      FROM raw GROUP BY r, c""",
    "points_xy": """
      SELECT event_id AS point_id, CAST((37 * user_id + 11 * event_id) % 1000 * 10 + event_id % 7 AS DOUBLE) AS x,
        CAST((53 * event_id + user_id) % 1000 * 10 + event_id % 5 AS DOUBLE) AS y, value FROM {events}""",
    "rects": """
      SELECT s_suppkey AS rect_id, CAST(s_suppkey % 10 * 1000 AS DOUBLE) AS x0, CAST(floor(s_suppkey / 10) % 10 * 1000 AS DOUBLE) AS y0,
        CAST(s_suppkey % 10 * 1000 + 300 + 10 * s_nationkey AS DOUBLE) AS x1, CAST(floor(s_suppkey / 10) % 10 * 1000 + 400 AS DOUBLE) AS y1 FROM {supplier}""",
    "truth": """
      SELECT DISTINCT r, CAST((c + 1) % 48 AS INT) AS c FROM raw WHERE CAST(floor(r / 6) * 7 + floor(c / 6) * 3 AS INT) % 5 = 0""",
}

#: The last row of the rasters, as SQL over DuckDB's views.
LAST_ROW = "(SELECT CAST(floor(max(l_orderkey) / 15000) * 48 + 47 AS INT) FROM lineitem)"

_BANDS = ("scenes", "band_days")
_NEEDS = {"band_days": ("scenes",), "coreg_bands": (*_BANDS, "band_rows"), "ifg_bands": (*_BANDS, "band_rows"), "s1_obs": ("raw",), "s2_obs": ("raw",), "psi_points": ("raw",), "truth": ("raw",)}


def with_clause(*names: str) -> str:
    """The WITH clause that defines ``names`` and what they need."""
    wanted = [n for n in CTES if n in names or any(n in _NEEDS.get(x, ()) for x in names)]
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in wanted)


def duckdb(sql: str, *names: str) -> str:
    """``sql`` after the WITH clause, over DuckDB's views; ``sql`` may go on with more definitions after a comma."""
    return with_clause(*names).format(**{t: t for t in TABLES}) + sql


def grid_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the rasters over the tables of ``sf_dir``."""
    last = spark.read.parquet(f"{sf_dir}/lineitem.parquet").agg({"l_orderkey": "max"}).first()[0]
    return ((last or 0) // 15000 + 1) * 48


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the derived tables over the Parquet tables of ``sf_dir``."""
    sql = with_clause(name) + f"\nSELECT * FROM {name}"
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)
