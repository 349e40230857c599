"""Run a query and its SQL side by side and compare all rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6) + 0.0
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, fn, sql, folder) -> tuple[bool, str]:
    got = fn(spark, folder)
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(got.columns):
        return False, f"columns {sorted(got.columns)} != {sorted(names)}"
    want = rows(names, expected.fetchall())
    have = rows(got.columns, got.collect())
    if want == have:
        return True, f"{len(have)} rows"
    extra = [r for r in have if r not in set(want)][:2]
    missing = [r for r in want if r not in set(have)][:2]
    return False, f"{len(have)} rows, want {len(want)}; only here {extra}; only in SQL {missing}"
