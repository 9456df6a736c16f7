"""Spark result against DuckDB result: names, number of rows, exact values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, [tuple(plain(v) for v in row) for row in df.select(*names).collect()]


def duckdb_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(plain(row[i]) for i in order) for row in result.fetchall()]
    return [columns[i] for i in order], rows


def typed(value) -> tuple:
    """Sort key and strict identity: 1, 1.0 and True are three values."""
    return (type(value).__name__, repr(value))


def differences(left, right) -> str | None:
    (names, rows), (other_names, other_rows) = left, right
    if names != other_names:
        return f"columns {names} and {other_names}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} and {len(other_rows)} rows"
    a = sorted(tuple(typed(v) for v in r) for r in rows)
    b = sorted(tuple(typed(v) for v in r) for r in other_rows)
    unequal = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(unequal)} rows differ, first: {unequal[0]}" if unequal else None
