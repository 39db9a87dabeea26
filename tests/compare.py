"""Run named queries against their SQL on the same files and report differences."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(type(value).__name__), value if value is not None else 0) for value in row)


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if columns, types and all rows are equal; else what differs."""
    found = connection.execute(sql)
    expected_types = {c[0]: str(c[1]) for c in found.description}
    names = sorted(df.columns)
    if names != sorted(expected_types):
        return f"columns {names} != {sorted(expected_types)}"
    order = [[c[0] for c in found.description].index(n) for n in names]
    expected = sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=_key)
    actual = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    if len(expected) != len(actual):
        return f"rows {len(actual)} != {len(expected)}"
    for got, want in zip(actual, expected):
        for name, a, b in zip(names, got, want):
            same = a == b and type(a) is type(b)
            if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
                same = True
            if not same:
                return f"{name}: {a!r} != {b!r} in {got} / {want}"
    return None
