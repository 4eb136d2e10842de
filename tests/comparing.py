"""Comparing a Spark result with the oracle's."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

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
    """The same value in one form, with its kind kept: an int never equals a string."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, dt.datetime):
        return ("timestamp", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    if isinstance(value, float):
        return ("float", repr(value))
    return value


def as_bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return as_bag(df.columns, df.collect())


def oracle_bag(connection, sql: str):
    cursor = connection.execute(sql)
    return as_bag([column[0] for column in cursor.description], cursor.fetchall())
