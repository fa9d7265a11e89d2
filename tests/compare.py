"""Compare a Spark result with the answer of its SQL in DuckDB, values and types."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int",
    "hugeint": "huge", "double": "float", "float": "float", "string": "text", "varchar": "text",
    "timestamp_ntz": "timestamp", "timestamp": "timestamp", "date": "date", "boolean": "boolean",
}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def difference(df, con, sql: str) -> str | None:
    """Why the two answers differ, or None."""
    ours = sorted((n, KINDS.get(k, k)) for n, k in df.dtypes)
    relation = con.sql(sql)
    theirs = sorted(
        (n, KINDS.get(str(k).lower(), str(k).lower())) for n, k in zip(relation.columns, relation.types)
    )
    if ours != theirs:
        return f"columns differ: {ours} / {theirs}"
    names = [n for n, _ in ours]
    left = Counter(tuple(canonical(r[n]) for n in names) for r in df.collect())
    places = [relation.columns.index(n) for n in names]
    right = Counter(tuple(canonical(r[i]) for i in places) for r in relation.fetchall())
    if left != right:
        return (
            f"{sum(left.values())} / {sum(right.values())} rows; "
            f"only ours {list((left - right).items())[:3]}; only theirs {list((right - left).items())[:3]}"
        )
    return None
