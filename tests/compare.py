"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(canonical(r[i]) for i in order) for r in rows),
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )


def compare(df, con, sql):
    """None when equal, else a short description of the difference."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; e.g. {[g for g in got if g not in set(want)][:2]} / {[w for w in want if w not in set(got)][:2]}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} != {w}"
    return None
