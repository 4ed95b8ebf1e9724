"""Compare a Spark result with the checking engine's, as unordered rows of named columns."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in data]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(con, sql: str, df) -> str | None:
    """None if equal, else a short description of the difference."""
    cur = con.execute(sql)
    want = rows([d[0] for d in cur.description], cur.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if want[0] != got[0]:
        return f"columns {got[0]} instead of {want[0]}"
    if len(want[1]) != len(got[1]):
        return f"{len(got[1])} rows instead of {len(want[1])}"
    wrong = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
