"""Comparison of queries with their SQL in DuckDB over the same tables."""

import datetime
import decimal
import glob
import os

import duckdb

DATA = os.environ.get("CHATLAKE_TEST_DATA", "/root/testdata/sf0.001")


def norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def views():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def compare(df, sql, con):
    cols = sorted(df.columns)
    ours = sorted(repr(tuple(norm(r[c]) for c in cols)) for r in df.collect())
    cur = con.execute(sql)
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    theirs = sorted(repr(tuple(norm(r[names.index(c)]) for c in cols)) for r in cur.fetchall())
    assert ours == theirs
