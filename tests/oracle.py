"""Compares a registered query with its SQL in DuckDB, value by value."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_normal(row[i]) for i in order) for row in rows), key=repr)


def compare(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    if not found:
        return "no rows to compare"
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(found)} rows differ, first {wrong[0]} ({sorted(names)})"
    types_found = {type(v) for row in found for v in row if v is not None}
    types_expected = {type(v) for row in expected for v in row if v is not None}
    if types_found != types_expected:
        return f"types {types_found} != {types_expected}"
    return None
