"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = ("documents", "labels", "embeddings", "conversations", "events", "benchmark", "pages")


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _kind(value: object) -> str:
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def _norm(rows: list[tuple], order: list[int]) -> list[tuple]:
    def cell(x):
        if isinstance(x, float) and math.isnan(x):
            return "nan"
        return x

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the two results; empty when they agree."""
    found = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    wanted = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    out = []
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if same.get(kind) != types[name]:
            out.append(f"type of {name}: {kind} against {types[name]}")
    left = _norm(found, [df.columns.index(c) for c in sorted(names)])
    right = _norm(wanted, [names.index(c) for c in sorted(names)])
    if len(left) != len(right):
        out.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        bad = [(a, b) for a, b in zip(left, right) if a != b][:2]
        out.append(f"values differ: {bad!r:.600}")
    return out
