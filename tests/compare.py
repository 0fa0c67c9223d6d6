"""Order-insensitive comparison of a Spark result with a SQL result."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None if both results agree in columns, types of values and rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    got = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    a, b = bag(df.columns, got), bag(names, expected)
    if a != b:
        return f"{len(got)} / {len(expected)} rows, {(a - b).most_common(2)} / {(b - a).most_common(2)}"
    types = {c: type(v) for c, v in zip(df.columns, got[0])} if got else {}
    other = {c: type(v) for c, v in zip(names, expected[0])} if expected else {}
    bad = [c for c in types if type(None) not in (types[c], other[c]) and types[c] != other[c]]
    return f"types {bad}" if bad else None
