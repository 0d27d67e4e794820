"""Incremental versions of the batch jobs on Structured Streaming.

Every query runs with ``availableNow``: it processes what is there, records it in its checkpoint
and stops. Starting it again picks up only what is new; a rerun after a failure repeats the
interrupted batch and overwrites its output.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators import events as E
from .levels import LevelledTable


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder or glob pattern as a stream of rows."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _watermarked(rows: DataFrame, delay: str) -> DataFrame:
    """Event time must be a TIMESTAMP to carry a watermark."""
    return rows.withColumn("created_at", F.col("created_at").cast("timestamp")).withWatermark(
        "created_at", delay
    )


def _append(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_event_ingest(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends new rows to a parquet table, each source file once."""
    return _append(rows, out, checkpoint)


def stream_dedupe(
    rows: DataFrame, out: str, checkpoint: str, key: str = "id", delay: str = "1 day"
) -> StreamingQuery:
    """As ingest, but a key delivered again within the delay is dropped.

    Rows older than the watermark are dropped too (see :func:`late_rows`).
    """
    unique = _watermarked(rows, delay).dropDuplicatesWithinWatermark([key])
    return _append(unique, out, checkpoint)


class LateRows(StreamingQueryListener):
    """Counts the rows that the queries of a session drop as later than the watermark, in every batch.

    A query keeps its last 100 progress reports only; this one gets each as it happens and adds it up. Add it with
    ``spark.streams.addListener`` before the query starts; a query that is started again from its checkpoint
    counts on under its id.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        with self._change:
            query = str(progress.id)
            self.dropped[query] = self.dropped.get(query, 0) + late
            self.batches[query] = self.batches.get(query, 0) + 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def count(self, query: StreamingQuery, patience: float = 60.0) -> int:
        """Late rows of all batches of a query that has ended; waits until its last report is here."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, patience):
                raise TimeoutError(f"query {query.id} has not reported its end")
            return self.dropped.get(str(query.id), 0)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as later than the watermark in the batches that the query still reports (Spark keeps the last 100).

    :class:`LateRows` counts over any number of batches.
    """
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def stream_time_buckets(
    rows: DataFrame, out: str, checkpoint: str, resolution: str = "hour", delay: str = "1 hour"
) -> StreamingQuery:
    """Events per closed time bucket and type."""
    return _append(E.events_per_bucket(_watermarked(rows, delay), resolution), out, checkpoint)


_MARK = "highest timestamp"


def stream_late_rows(
    rows: DataFrame, late: str, checkpoint: str, resolution: str = "hour", delay: str = "1 hour"
) -> StreamingQuery:
    """Keeps (bucket_start, type, n) of rows that :func:`stream_time_buckets` may have dropped as late.

    A row is late where its bucket had ended, by the delay, before the latest event seen so far, that of its own batch
    included. Batches of any cut therefore find every row that the other query drops, or more. Each batch
    leaves its rows and the latest event under its number; a repeated batch overwrites both.
    """
    spark = rows.sparkSession

    def apply(batch: DataFrame, number: int) -> None:
        times = batch.withColumn("created_at", F.col("created_at").cast("timestamp"))
        before = spark.read.schema(_MARK).parquet(f"{late}/marks/ingest={number - 1}") if number else spark.createDataFrame([], _MARK)
        highest = times.agg(F.max("created_at").alias("highest")).union(before).agg(F.max("highest").alias("highest"))
        highest.coalesce(1).write.mode("overwrite").parquet(f"{late}/marks/ingest={number}")
        # one row, read back from what was written
        mark = F.broadcast(spark.read.schema(_MARK).parquet(f"{late}/marks/ingest={number}"))
        bucket = F.window("created_at", E.BUCKETS[resolution])
        closed = times.withColumn("w", bucket).join(mark, F.col("w.end") <= F.col("highest") - F.expr(f"interval {delay}"))
        counts = closed.groupBy(F.col("w.start").alias("bucket_start"), "type").agg(F.count(F.lit(1)).alias("n"))
        counts.write.mode("overwrite").parquet(f"{late}/rows/ingest={number}")

    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


LATE = "bucket_start timestamp, type string, n long"


def repaired_buckets(buckets: DataFrame, late: DataFrame, events: DataFrame, resolution: str = "hour") -> DataFrame:
    """The closed buckets as the whole archive gives them: those that late rows touch are counted anew from their events.

    Only events of the touched buckets are read for it; all other rows stay as the stream left them.
    """
    touched = late.select("bucket_start").distinct()
    emitted = buckets.select("bucket_start").distinct()
    # a bucket whose rows were all late was never emitted, but is closed as well
    size = E.BUCKETS[resolution]
    theirs = events.withColumn("bucket_start", F.window("created_at", size)["start"]).join(touched, "bucket_start", "left_semi")
    anew = E.events_per_bucket(theirs, resolution)
    closed_until = emitted.union(touched).agg(F.max("bucket_start").alias("last"))
    anew = anew.join(F.broadcast(closed_until), F.col("bucket_start") <= F.col("last")).drop("last")
    return buckets.join(touched, "bucket_start", "left_anti").unionByName(anew)


STATS_PARTS = "year long, organization_login string, repo_id long, actor_id long, forks long, stars long"


def stats_table(spark: SparkSession, stats: str) -> LevelledTable:
    """The distinct (year, organization, repository, actor) rows of all batches, in a bounded number of parts."""
    return LevelledTable(spark, stats, STATS_PARTS, E.fewer_parts)


def stream_org_upsert(
    events: DataFrame, archive: str, stats: str, checkpoint: str, start_year: int, end_year: int
) -> StreamingQuery:
    """Keeps yearly organization statistics current as archive events arrive.

    A batch is evaluated once: it is added to the archive, by year, under its number, and what was written
    gives its distinct (year, organization, repository, actor) rows with their counts, a part of a levelled
    table. Nothing of earlier batches is read but the parts that are merged when their level is full. Both
    outputs are overwritten when the batch is repeated. :func:`current_stats` reads the table. An event that
    is delivered twice counts twice in forks and stars; :func:`stream_dedupe` in front drops such events.
    """
    spark = events.sparkSession
    table = stats_table(spark, stats)
    schema = events.schema

    def apply(batch: DataFrame, number: int) -> None:
        written = f"{archive}/ingest={number}"
        batch.withColumn("year", F.year("created_at")).write.mode("overwrite").partitionBy("year").parquet(written)
        table.add(number, E.org_yearly_parts(spark.read.schema(schema).parquet(written), start_year, end_year))

    return (
        events.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_stats(spark: SparkSession, stats: str) -> DataFrame:
    """Per year and organization, over all batches: repositories, forks, stars and contributors; no rows before the first."""
    return E.merged_parts(stats_table(spark, stats).read())
