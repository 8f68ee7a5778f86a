"""Compare registered queries with their SQL, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, int):
        return float(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql, limit=3):
    """Empty when both give the same columns and rows."""
    cur = con.execute(sql)
    theirs_names = [d[0] for d in cur.description]
    theirs = rows_of(theirs_names, cur.fetchall())
    ours = rows_of(df.columns, df.collect())
    if sorted(df.columns) != sorted(theirs_names):
        return [f"columns {sorted(df.columns)} != {sorted(theirs_names)}"]
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} != {len(theirs)}"]
    return [f"{a} != {b}" for a, b in zip(ours, theirs) if a != b][:limit]
