"""Run a registered query and its SQL twin and compare the rows."""

from __future__ import annotations

import math
import os

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0  # -0.0 equals 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides hold the same rows, else the first difference."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns: {sorted(df.columns)} against {sorted(names)}"
    if len(want) != len(got):
        return f"rows: {len(got)} against {len(want)}"
    for w, g in zip(want, got):
        if w != g:
            pairs = [(n, a, b) for n, a, b in zip(sorted(names), g, w) if a != b]
            return f"first differing row: {pairs[:4]}"
    return None
