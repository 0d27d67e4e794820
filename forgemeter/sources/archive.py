"""The event archive: parquet, one partition per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.dates import day_suffix
from ..schemas import ARCHIVE_EVENTS


def write_archive(events: DataFrame, path: str) -> None:
    """Appends events to the archive.

    The rebalance hint lets Spark split a day that holds much of the data over several tasks and
    files, and merge small days.
    """
    dated = events.withColumn("day", day_suffix(F.col("created_at")))
    dated.hint("rebalance", F.col("day")).write.mode("append").partitionBy("day").parquet(path)


def scan_archive(
    spark: SparkSession,
    path: str,
    first_day: str,
    last_day: str,
    since: str | None = None,
    until: str | None = None,
    schema: str | StructType = ARCHIVE_EVENTS,
) -> DataFrame:
    """Events of the day partitions in [first_day, last_day] (``yyyyMMdd``), optionally within
    [since, until]. The day test prunes partitions, the time test reaches the scan;
    the schema is given, not read from the files."""
    events = spark.read.schema(schema).option("basePath", path).parquet(path)
    events = events.where(F.col("day").between(first_day, last_day))
    if since is not None:
        events = events.where(F.col("created_at") >= since)
    if until is not None:
        events = events.where(F.col("created_at") <= until)
    return events
