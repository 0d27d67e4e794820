"""Lookups in fixed tables whose cost does not depend on the length of the table.

Spark walks a map literal, and an array of rules, from the front. Here a table is a constant array of buckets
by a checksum of the key: a lookup computes one checksum and compares the few keys of one bucket. Texts are
not compared with rules one by one either: the phrases of a text that a rule could name are looked up.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F


@functools.cache
def _buckets(rows: tuple[tuple[str, str], ...]) -> tuple[int, str]:
    size = 1 << max(0, (len(rows) - 1).bit_length())
    dealt: list[list[dict]] = [[] for _ in range(size)]
    for key, value in rows:
        dealt[zlib.crc32(key.encode()) % size].append({"k": key, "v": json.loads(value)})
    return size, json.dumps(dealt)


def constant_lookup(table: Mapping[str, object], value_type: str = "string") -> Callable[[Column], Column]:
    """A function from a key column to the table's value, null for unknown and null keys."""
    size, text = _buckets(tuple((key, json.dumps(value)) for key, value in table.items()))
    buckets = F.from_json(F.lit(text), f"array<array<struct<k: string, v: {value_type}>>>")

    def look_up(key: Column) -> Column:
        bucket = F.get(buckets, (F.crc32(key.cast("binary")) % size).cast("int"))
        return F.get(F.filter(bucket, lambda row: row["k"] == key), F.lit(0)).getField("v")

    return look_up


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_runs(text: Column, longest: int) -> Column:
    """Every run of one to ``longest`` consecutive words of a text, words being what stands between single spaces."""

    def runs(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(words))
        lengths = F.sequence(F.lit(1), F.lit(longest))
        return F.flatten(
            F.transform(
                starts,
                lambda at: F.transform(
                    F.filter(lengths, lambda n: at + n - 1 <= F.size(words)),
                    lambda n: F.array_join(F.slice(words, at, n), " "),
                ),
            )
        )

    return let(F.split(text, " "), runs)


def leading_runs(text: Column, longest: int) -> Column:
    """The runs of one to ``longest`` words that begin a text and end at a space, at its first comma or at its end."""
    head = F.substring_index(F.concat(text, F.lit(" ")), ",", 1)
    return F.array(*[F.substring_index(head, " ", n) for n in range(1, longest + 1)])


def longest_key(keys) -> int:
    """Most words of a key."""
    return max((key.count(" ") + 1 for key in keys), default=1)


def first_ranked(runs: Column, look_up: Callable[[Column], Column]) -> Column:
    """The value of the known run with the lowest rank, from a table of ``struct<rank, code>``."""
    found = F.filter(F.transform(runs, look_up), lambda row: row.isNotNull())
    return F.array_min(found).getField("code")
