"""Compare a query with its SQL: names, row count and values, in any order."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def tables_of(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    rows = []
    ordered = frame[sorted(frame.columns)]
    for row in ordered.itertuples(index=False, name=None):
        rows.append(tuple(_plain(value) for value in row))
    return sorted(rows, key=repr)


def _plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return value


def difference(got: pd.DataFrame, wanted: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(wanted.columns):
        return f"columns {sorted(got.columns)} instead of {sorted(wanted.columns)}"
    left, right = canonical(got), canonical(wanted)
    if len(left) != len(right):
        return f"{len(left)} rows instead of {len(right)}"
    for mine, theirs in zip(left, right):
        if mine != theirs:
            return f"{mine!r} instead of {theirs!r}"
    return None
