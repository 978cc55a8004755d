"""Row-for-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def differences(spark_df, connection, statement, limit=5):
    """Empty when both sides have the same columns and rows; values must be exactly equal."""
    got_names = spark_df.columns
    cursor = connection.execute(statement)
    want_names = [column[0] for column in cursor.description]
    if sorted(got_names) != sorted(want_names):
        return [f"columns differ: {sorted(set(got_names) ^ set(want_names))}"]
    got = _rows(got_names, [tuple(row) for row in spark_df.collect()])
    want = _rows(want_names, cursor.fetchall())
    if len(got) != len(want):
        return [f"row counts differ: {len(got)} and {len(want)}"]
    names = sorted(got_names)
    found = []
    for mine, theirs in zip(got, want):
        for name, a, b in zip(names, mine, theirs):
            if a != b or type(a) is not type(b):
                found.append(f"{name}: {a!r} and {b!r}")
        if len(found) >= limit:
            break
    return found
