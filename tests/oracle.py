"""Compare a Spark result with DuckDB's on the same tables, row by row."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or isinstance(value, (str, bool, int)):
        return value
    value = float(value)
    return "nan" if math.isnan(value) else value + 0.0


def difference(con: duckdb.DuckDBPyConnection, sql: str, df) -> str:
    """What differs, or an empty string."""
    want = con.sql(sql)
    names = sorted(want.columns)
    if names != sorted(df.columns):
        return f"columns {sorted(df.columns)}, expected {names}"
    key = lambda row: tuple((x is None, str(type(x) is str), x if x is not None else 0) for x in row)
    a = sorted((tuple(map(_plain, row)) for row in df.select(*names).collect()), key=key)
    b = sorted((tuple(map(_plain, row)) for row in want.select(*[f'"{n}"' for n in names]).fetchall()), key=key)
    if len(a) != len(b):
        return f"{len(a)} rows, expected {len(b)}: {a[:2]} {b[:2]}"
    odd = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(odd)} of {len(a)} rows differ: {odd[:2]}" if odd else ""
