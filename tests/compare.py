"""Runs queries in Spark and their SQL in DuckDB over the same tables and says where they differ."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb


def canonical(value):
    """A value that compares equal whichever engine it came from."""
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else f"{value:.9g}")
    if isinstance(value, int):
        return (1, f"{float(value):.9g}" if abs(value) < 2**53 else str(value))
    if isinstance(value, dt.datetime):
        return (1, value.replace(tzinfo=None).isoformat())
    if isinstance(value, (list, tuple)):
        return (1, str([canonical(v) for v in value]))
    return (1, str(value))


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def differences(spark, query, sql: str, folder: str) -> str:
    """'' if query and SQL agree in columns and rows."""
    df = query(spark, folder)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    got = [tuple(r) for r in df.collect()]
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        first = next(((x, y) for x, y in zip(a, b, strict=False) if x != y), ("", ""))
        return f"{len(a)} and {len(b)} rows; first difference {str(first)[:400]}"
    return ""
