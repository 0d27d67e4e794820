"""Names every checked query and pairs it with the SQL it must agree with.

``@check("name", sql)`` registers a function (spark, sf_dir) -> DataFrame. The SQL is written over
the analytics tables; :func:`with_tables` puts the definitions it uses in front.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..workspace import fresh_path
from .sql_tables import TABLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _used(text: str) -> list[str]:
    names = [name for name in TABLES if re.search(rf"\b{name}\b", text)]
    return sorted(names, key=list(TABLES).index)


def with_tables(body: str) -> str:
    needed: set[str] = set()
    todo = _used(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += _used(TABLES[name])
    parts = [f"{name} AS ({TABLES[name].strip()})" for name in TABLES if name in needed]
    body = body.strip()
    if not parts:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {', '.join(parts)}, {body[5:]}"
    return f"WITH {', '.join(parts)} {body}"


def check(name: str, sql: str | None = None):
    def register(query: Query) -> Query:
        assert name not in QUERIES, name
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = with_tables(sql)
        return query

    return register


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a stored table: written once, read as often as needed."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def text(column: str | Column, name: str | None = None) -> Column:
    """A date, time or optional number as text, which compares the same everywhere."""
    col = F.col(column) if isinstance(column, str) else column
    return col.cast("string").alias(name or column)


def time_text(column: str, name: str | None = None) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name or column)
