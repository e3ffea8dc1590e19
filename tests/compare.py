"""Comparing a query with its SQL equivalent, without regard to row order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def normal(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(table, key=lambda row: tuple(str(v) for v in row))


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, empty if nothing does."""
    cursor = con.execute(sql)
    expected = normal([d[0] for d in cursor.description], cursor.fetchall())
    found = normal(df.columns, df.collect())
    if expected[0] != found[0]:
        return [f"columns {found[0]} instead of {expected[0]}"]
    if len(expected[1]) != len(found[1]):
        return [f"{len(found[1])} rows instead of {len(expected[1])}"]
    pairs = [(f, e) for f, e in zip(found[1], expected[1]) if f != e]
    return [f"{len(pairs)} rows differ"] + [f"found    {f}\nexpected {e}" for f, e in pairs[:3]] if pairs else []
