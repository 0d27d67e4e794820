"""Prints how every checked query compares with its SQL: ``run_checks.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from compare import connect, difference, spark_rows, sql_rows  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    wrong = 0
    for name in names:
        start = time.time()
        try:
            left = spark_rows(queries[name](spark, sf_dir))
            took = time.time() - start
            verdict = difference(left, sql_rows(connection, oracle[name])) if name in oracle else "no SQL"
        except Exception as error:  # noqa: BLE001
            took = time.time() - start
            verdict = f"{type(error).__name__}: {str(error)[:400]}"
            if len(names) < 4:
                traceback.print_exc()
        if verdict:
            wrong += 1
        print(f"{name:32s} {took:6.2f}s {verdict or 'ok'} {'' if verdict else len(left[1])}", flush=True)
    print(f"{len(names) - wrong} of {len(names)} agree")


main()
