"""Joins with heavy keys, the first rows of a table and shuffles by size, without a task that gets much more than its share.

Adaptive execution splits a skewed partition where a join allows it; these operations do not depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..workspace import stored

#: A key is heavy from this part of a task's share of the rows on, and is cut into pieces of that size.
PIECES = 32

#: Rows of a shuffle by size that one task gets, and the rows from which on a shuffle is by size.
TASK_ROWS, MANY_ROWS = 250_000, 1_000_000


def tasks_for(table: DataFrame) -> int | None:
    """How many tasks a shuffle of a table's rows is cut into; None for few rows, which are left to the session's setting.

    Counted, which Spark does from the footers of a stored table. The session's number of partitions is fixed and
    adaptive execution only merges them, up to one a core, so what a task holds would grow with the table.
    """
    rows = table.count()
    return None if rows < MANY_ROWS else -(-rows // TASK_ROWS)


def dealt(rows: DataFrame, tasks: int | None, *keys: Column | str) -> DataFrame:
    """The rows by their keys in so many tasks; as they are for None, where the next operation shuffles them by the session's setting."""
    return rows if tasks is None else rows.repartition(tasks, *keys)


def heavy_keys(rows: DataFrame, key: str, tasks: int | None = None, pieces: int = PIECES) -> DataFrame:
    """(key, n_pieces) of the keys with more than one piece.

    Counted with a map-side combine. A piece is total / (tasks * pieces) rows, so there are at most tasks * pieces
    such keys and twice as many pieces, whatever the data.
    """
    if tasks is None:
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.count(F.lit(1)).alias("total")).scalar()
    n_pieces = F.ceil(F.col("_n") * F.lit(tasks * pieces) / F.greatest(total, F.lit(1)))
    return counts.select(key, n_pieces.cast("int").alias("_pieces")).where(F.col("_pieces") > 1)


def join_heavy(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", tasks: int | None = None, pieces: int = PIECES
) -> DataFrame:
    """``left.join(right, key, how)`` for inner and left joins, where keys of ``left`` may be heavy.

    The rows of a heavy key go to pieces by a hash of the row, and the rows of ``right`` with that key are repeated for
    each piece; all other rows are untouched. The table of heavy keys has a bound (see :func:`heavy_keys`), so it is
    broadcast. Equal rows share a piece; null keys match nothing and are spread too.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    heavy = F.broadcast(heavy_keys(left, key, tasks, pieces))
    row_hash = F.xxhash64(*left.columns)
    dealt = left.join(heavy, key, "left").withColumn(
        "_piece", F.when(F.col(key).isNull(), row_hash).otherwise(F.pmod(row_hash, F.coalesce("_pieces", F.lit(1))))
    )
    numbers = F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1)).cast("long") - 1)
    repeated = right.join(heavy, key, "left").withColumn("_piece", F.explode(numbers)).drop("_pieces")
    return dealt.drop("_pieces").join(repeated, [key, "_piece"], how).drop("_piece")


def first_rows(df: DataFrame, total: int, order: list[Column | str]) -> DataFrame:
    """The first ``total`` rows in an order, for totals of any size.

    Rows are dealt out by ranges of the order and stored with the number of their range. The counts of
    the ranges (a row each) tell which lie before the cut, which behind, and the one that holds it; only that range
    is ranked, in one task that holds no more than any task did. The order should end with a key: rows that are equal in it
    stay together in one range.
    """
    dealt = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "first-rows")
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    quota = counts.withColumn("_left", F.lit(total) - F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    whole = quota.where(F.col("_left") >= F.col("_rows")).select("_range")
    cut = quota.where((F.col("_left") > 0) & (F.col("_left") < F.col("_rows"))).select("_range", "_left")
    kept = dealt.join(F.broadcast(whole), "_range", "left_semi")
    ranked = dealt.join(F.broadcast(cut), "_range").withColumn("_rank", F.row_number().over(W.partitionBy("_range").orderBy(*order)))
    return kept.select(*df.columns).unionByName(ranked.where(F.col("_rank") <= F.col("_left")).select(*df.columns))
