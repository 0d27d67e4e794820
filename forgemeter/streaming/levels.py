"""A table of mergeable parts that a stream adds to, compacted by levels.

Batch n leaves one part of level 0. As in a counter, ``FAN`` parts of one level become one part of the next as soon
as they are there, so after n batches at most ``(FAN - 1) * (log_FAN(n) + 1)`` parts are live, and a row is rewritten
once a level. Which parts are live follows from n alone, which makes a repeated batch write the same parts again.

The manifest says up to which batch the table is complete and lists the live parts. It has two slots that batches
write in turn: while one is rewritten the other is whole. Parts that neither slot names are emptied, so readers of the
last manifest are never disturbed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

FAN = 8
_MANIFEST = "batch long, level int, number long"


def live_parts(batch: int, fan: int = FAN) -> list[tuple[int, int]]:
    """(level, number) of the parts after a batch, from the oldest rows to the newest: the digits of batch + 1."""
    parts, level, left = [], 0, max(0, batch + 1)
    while left:
        parts += [(level, number) for number in range(left // fan * fan, left)][::-1]
        left, level = left // fan, level + 1
    return parts[::-1]


def written_parts(batch: int, fan: int = FAN) -> list[tuple[int, int]]:
    """(level, number) of the parts that adding a batch writes."""
    parts, level, number = [(0, batch)], 0, batch
    while (number + 1) % fan == 0:
        level, number = level + 1, number // fan
        parts.append((level, number))
    return parts


class LevelledTable:
    """The parts below ``path``, of one fixed schema; ``merge`` makes equivalent, fewer rows of the rows of several parts."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, merge: Callable[[DataFrame], DataFrame], fan: int = FAN):
        self.spark, self.path, self.merge, self.fan = spark, path.rstrip("/"), merge, fan
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _part(self, level: int, number: int) -> str:
        return f"{self.path}/level={level}/part={number}"

    def _slot(self, batch: int) -> str:
        return f"{self.path}/manifest-{batch % 2}"

    def _empty(self, schema: T.StructType | str) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _read_parts(self, parts: list[tuple[int, int]]) -> DataFrame:
        if not parts:
            return self._empty(self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._part(*part) for part in parts])

    def manifest(self) -> tuple[int, list[tuple[int, int]]]:
        """The last complete batch (-1 before the first) and its live parts; at most a few dozen rows are read."""
        found: dict[int, list[tuple[int, int]]] = {}
        for slot in (0, 1):
            try:
                rows = self.spark.read.schema(_MANIFEST).parquet(self._slot(slot)).collect()
            except AnalysisException:  # no batch has written this slot
                continue
            for row in rows:
                found.setdefault(row["batch"], []).append((row["level"], row["number"]))
        last = max(found, default=-1)
        return last, found.get(last, [])

    def read(self) -> DataFrame:
        """All rows of the complete batches; the fixed schema without any, before the first batch."""
        return self._read_parts(self.manifest()[1])

    def add(self, batch: int, rows: DataFrame) -> None:
        """Adds a batch, merges what is due and says so in the manifest. Adding the same batch again changes nothing."""
        columns = [F.col(field.name).cast(field.dataType).alias(field.name) for field in self.schema.fields]
        rows.select(*columns).write.mode("overwrite").parquet(self._part(0, batch))
        for level, number in written_parts(batch, self.fan)[1:]:
            merged = self.merge(self._read_parts([(level - 1, number * self.fan + n) for n in range(self.fan)]))
            merged.select(*columns).write.mode("overwrite").parquet(self._part(level, number))
        live = live_parts(batch, self.fan)
        listed = self.spark.createDataFrame([(batch, *part) for part in live], _MANIFEST)
        listed.coalesce(1).write.mode("overwrite").parquet(self._slot(batch))
        if batch:
            before = {*live_parts(batch - 2, self.fan), *written_parts(batch - 1, self.fan)}
            for part in before - {*live, *live_parts(batch - 1, self.fan)}:
                self._empty(self.schema).write.mode("overwrite").parquet(self._part(*part))
