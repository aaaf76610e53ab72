"""Runs a query beside its SQL and compares the rows."""

import glob
import math
import os


def connect(sf, tables):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in tables:
        path = f"{sf}/{t}.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        if glob.glob(path):
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    return v.item() if hasattr(v, "item") else v


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr(tuple(plain(v) for v in r)) for r in frame.itertuples(index=False, name=None))


def assert_same(df, con, sql):
    a, b = df.toPandas(), con.execute(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)
