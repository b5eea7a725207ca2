"""Runs a query in Spark and its SQL in DuckDB over the same tables and compares the rows."""

import glob
import os

import duckdb


def rows(df, columns):
    return sorted((tuple(None if v is None else round(v, 5) + 0.0 if isinstance(v, float) else str(v) if not isinstance(v, int | bool) else v for v in (r[c] for c in columns)) for r in df), key=repr)


def compare(spark, query, sql, sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    rel = con.sql(sql)
    names = rel.columns
    want = [dict(zip(names, r, strict=True)) for r in rel.fetchall()]
    got = query(spark, sf_dir)
    assert sorted(got.columns) == sorted(names), (got.columns, names)
    found = [r.asDict() for r in got.collect()]
    names = sorted(names)
    a, b = rows(found, names), rows(want, names)
    differing = list(set(a) - set(b))[:3], list(set(b) - set(a))[:3]
    assert len(a) == len(b) and a == b, (len(a), len(b), differing)
    return len(a)
