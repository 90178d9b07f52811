"""Run a query in Spark and in DuckDB and compare the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat()
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None if both give the same bag of rows, else a short description."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    theirs = rel.fetchall()
    mine = [tuple(r) for r in df.collect()]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = _bag(df.columns, mine), _bag(names, theirs)
    if a == b:
        return None
    only_a = [str(r)[:300] for r in (a - b)][:2]
    only_b = [str(r)[:300] for r in (b - a)][:2]
    return f"{len(mine)} vs {len(theirs)} rows; only in Spark {only_a}; only in DuckDB {only_b}"
