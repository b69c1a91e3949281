"""Compare registered queries with their DuckDB SQL on the fixture tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "item"):
        return plain(value.item())
    return value


def rows(columns: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both have the same columns and rows."""
    found = con.sql(sql)
    if sorted(df.columns) != sorted(found.columns):
        return f"columns {sorted(df.columns)} and {sorted(found.columns)}"
    a, b = rows(df.columns, [tuple(r) for r in df.collect()]), rows(found.columns, found.fetchall())
    if a == b:
        return ""
    odd = [x for x in zip(a, b) if x[0] != x[1]][:3]
    return f"{len(a)} and {len(b)} rows; {odd}"
