"""Spark rows and DuckDB rows of one query, in a form that can be compared."""

import datetime
import glob
import math
import os

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) if not isinstance(v, (int, float)) or isinstance(v, bool) else (True, "n", float(v)) for v in r))


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    rel = con.sql(sql)
    ours, theirs = rows(df.columns, df.collect()), rows(rel.columns, rel.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    for a, b in zip(ours[1], theirs[1]):
        assert all(x == y or (isinstance(x, float) and abs(x - y) <= 1.1e-4 * max(1, abs(x))) for x, y in zip(a, b)), (a, b)
