"""Runs a named query on both engines and compares names, row counts and values."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return ("f", repr(v + 0.0))
    if isinstance(v, (bool, datetime.datetime, datetime.date, str)):
        return (type(v).__name__, str(v))
    if isinstance(v, decimal.Decimal):
        return ("d", str(v))
    return ("i", str(int(v)))


def difference(df, con, sql: str) -> str | None:
    names = sorted(df.columns)
    ours = sorted((tuple(_cell(r[c]) for c in names) for r in df.collect()), key=repr)
    rel = con.execute(sql)
    cols = [c[0] for c in rel.description]
    if sorted(cols) != names:
        return f"columns {names} against {sorted(cols)}"
    at = [cols.index(n) for n in names]
    theirs = sorted((tuple(_cell(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return "\n".join(f"{n}: {x} against {y}" for n, x, y in zip(names, a, b) if x != y) + f"\nrow {a}"
    return None
