"""Session settings the jobs are written for.

Nothing here is applied by itself; pass the result to ``SparkSession.builder.config(map=...)``.
"""

from __future__ import annotations


def cluster_settings(total_cores: int, input_terabytes: float = 1.0) -> dict[str, str]:
    """Shuffles start with partitions of about 128 MB of the input and are merged at run time.

    Adaptive execution splits skewed join partitions and turns joins into broadcasts where a side
    proves small; timestamps are read as UTC.
    """
    by_size = int(input_terabytes * 1024 * 1024 / 128)
    partitions = max(total_cores * 3, by_size)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
