"""Comparing a Spark result with the same query in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
from collections import Counter

import duckdb


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{folder}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def rows_of(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, query, sql: str, folder: str) -> str:
    """'' if both agree, else what differs."""
    df = query(spark, folder)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = connect(folder).execute(sql)
    names = [x[0] for x in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    a, b = ours - theirs, theirs - ours
    return f"{sum(a.values())} only in Spark, such as {list(a)[:3]}; {sum(b.values())} only in SQL, such as {list(b)[:3]}" if a or b else ""
