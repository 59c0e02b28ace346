"""Compare a query with its SQL in DuckDB, value by value."""

from __future__ import annotations

import datetime as dt

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _value(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_value(r[i]) for i in order] for r in rows), key=repr)


def differences(spark, connection, sf_dir, query, sql) -> str | None:
    """What differs, or None."""
    mine = query(spark, sf_dir)
    columns = mine.columns
    result = connection.execute(sql)
    theirs = [d[0] for d in result.description]
    if sorted(columns) != sorted(theirs):
        return f"columns {columns} and {theirs}"
    left, right = _sorted(mine.collect(), columns), _sorted(result.fetchall(), theirs)
    if len(left) != len(right):
        return f"{len(left)} rows and {len(right)} rows"
    for a, b in zip(left, right, strict=True):
        if a != b:
            return f"{a} and {b}"
    return None
