"""Runs checked queries against DuckDB on the same parquet files."""

from __future__ import annotations

import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        raise AssertionError(f"decimal value {value}")
    if isinstance(value, float):
        return f"{value:.9g}"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(found, key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(connection, sql):
    result = connection.execute(sql)
    columns = [item[0] for item in result.description]
    return _rows(columns, result.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])} rows"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if repr(a) != repr(b)]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0][0]} != {wrong[0][1]}"
    return None
