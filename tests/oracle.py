"""Compares a query with its SQL in DuckDB: sorted columns, rows as multisets, floats rounded."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def difference(df, sql: str, con) -> str:
    """'' if both give the same columns and rows, else what differs."""
    got = df.collect()
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    rows = want.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    order = sorted(names)
    a = Counter(tuple(plain(r[c]) for c in order) for r in got)
    at = [names.index(c) for c in order]
    b = Counter(tuple(plain(r[i]) for i in at) for r in rows)
    if a == b:
        return ""
    return f"{sum(a.values())} and {sum(b.values())} rows; only here {list((a - b).items())[:2]}; only there {list((b - a).items())[:2]}"
