"""Compare a registered Spark query with its SQL on the same tables."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, type(x).__name__ if not isinstance(x, (int, float)) else "n", str(x)) for x in row)


def difference(df, con, sql: str) -> str | None:
    """None when rows and column names agree, else a short description."""
    rel = con.sql(sql)
    names, theirs = rel.columns, rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    order = sorted(df.columns)
    ours = sorted(
        (tuple(_plain(v) for v in r) for r in df.select(*order).collect()), key=_key
    )
    at = [names.index(n) for n in order]
    theirs = sorted((tuple(_plain(r[i]) for i in at) for r in theirs), key=_key)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    # repr also tells 1 from 1.0 and from True
    wrong = [(a, b) for a, b in zip(ours, theirs) if repr(a) != repr(b)]
    if wrong:
        a, b = wrong[0]
        fields = [(n, x, y) for n, x, y in zip(order, a, b) if repr(x) != repr(y)]
        return f"{len(wrong)} of {len(ours)} rows differ, first: {str(fields)[:600]}"
    return None
