"""Compare a Spark result with the expected result, whatever the row order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else ("f", value + 0.0)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def differences(df, con, sql) -> list[str]:
    """Human-readable differences; empty when both results are the same."""
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    expected_names, expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if names != expected_names:
        return [f"columns: only spark {sorted(set(names) - set(expected_names))}, only sql {sorted(set(expected_names) - set(names))}"]
    if len(got) != len(expected):
        return [f"rows: spark {len(got)}, sql {len(expected)}"]
    found = []
    bad = [(g, e) for g, e in zip(got, expected) if g != e]
    if bad:
        columns = sorted({names[i] for g, e in bad for i in range(len(names)) if g[i] != e[i]})
        g, e = bad[0]
        sample = {names[i]: (g[i], e[i]) for i in range(len(names)) if g[i] != e[i]}
        found.append(f"{len(bad)} rows differ in {columns}; first: {sample}")
    return found
