"""Reports over pipeline metrics and run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """One row: last counters, mean and peak throughput and memory; no row without metrics."""
    at = F.col("timestamp")
    return metrics.agg(
        F.count(F.lit(1)).alias("_n"),
        F.timestamp_diff("SECOND", F.min(at), F.max(at)).alias("duration_seconds"),
        F.max_by("events_processed", at).alias("total_events"),
        F.avg("throughput").alias("avg_throughput"),
        F.max("throughput").alias("max_throughput"),
        F.avg("memory_usage").alias("avg_memory_mb"),
        F.max("memory_usage").alias("max_memory_mb"),
        F.max_by("errors", at).alias("total_errors"),
        F.max_by("api_calls", at).alias("total_api_calls"),
        F.max_by("db_operations", at).alias("total_db_ops"),
    ).where(F.col("_n") > 0).drop("_n")


def run_ratios(summaries: DataFrame) -> DataFrame:
    """Adds events per second and megabytes per repository; null over zero."""
    return summaries.withColumns(
        {
            "events_per_second": F.try_divide("total_events", "duration_seconds"),
            "mb_per_repository": F.try_divide("max_memory_mb", "repositories_processed"),
        }
    )


def timing_breakdown(summaries: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, component, duration): API, warehouse and the rest of the run."""
    other = F.col("duration_seconds") - F.col("api_duration_seconds") - F.col("bigquery_duration_seconds")
    wide = summaries.select(
        *keys,
        F.col("api_duration_seconds").alias("api"),
        F.col("bigquery_duration_seconds").alias("bigquery"),
        other.alias("other"),
    )
    return wide.unpivot(keys, ["api", "bigquery", "other"], "component", "duration")


def event_type_counts(summaries: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, event_type, count) of the ``events_by_type`` map text."""
    counts = F.from_json("events_by_type", "map<string,bigint>", {"allowSingleQuotes": "true"})
    return summaries.select(*keys, F.explode(counts).alias("event_type", "count"))
