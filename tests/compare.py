"""Runs a query and its SQL text side by side and describes the first difference."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def database(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(connection, frame, sql: str) -> str | None:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    actual = _rows(frame.columns, frame.collect())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} expected {sorted(names)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for got, want in zip(actual, expected):
        if got != want or [type(v) for v in got] != [type(v) for v in want]:
            return f"{str(got)[:700]} expected {str(want)[:700]}"
    return None
