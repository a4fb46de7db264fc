"""Side-by-side run of a query and its SQL counterpart."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(directory) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> list[str]:
    """What differs between a DataFrame and an SQL result, as bags of rows."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = _bag(result.fetchall(), names)
    actual = _bag([tuple(r) for r in frame.collect()], frame.columns)
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    if expected == actual:
        return []
    extra = [r for r in actual if r not in set(expected)][:3]
    missing = [r for r in expected if r not in set(actual)][:3]
    return [f"{len(actual)} rows against {len(expected)}", f"only here: {extra}", f"only SQL: {missing}"]
