"""Comparison of a query with its SQL on the same folder of tables."""

from __future__ import annotations

import math
import pathlib

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(pathlib.Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _value(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return repr(value)
    if isinstance(value, (int, float)):
        if isinstance(value, float) and math.isnan(value):
            return "nan"
        return repr(round(float(value), 9))
    return str(value)


def _lines(columns, rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def mismatch(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides have the same columns and rows, else what differs."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but SQL has {sorted(names)}"
    ours, theirs = _lines(df.columns, df.collect()), _lines(names, expected.fetchall())
    if ours == theirs:
        return None
    only_ours = sorted(set(ours) - set(theirs))[:3]
    only_theirs = sorted(set(theirs) - set(ours))[:3]
    return f"{len(ours)} rows but SQL has {len(theirs)}; only ours {only_ours}; only SQL {only_theirs}"
