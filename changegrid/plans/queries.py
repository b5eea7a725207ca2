"""Registered queries over the given tables, each with its DuckDB SQL."""

from __future__ import annotations

from changegrid.plans import queries_io, queries_points, queries_raster

QUERIES = {**queries_raster.QUERIES, **queries_points.QUERIES, **queries_io.QUERIES}
ORACLE_SQL = {**queries_raster.ORACLE_SQL, **queries_points.ORACLE_SQL, **queries_io.ORACLE_SQL}
