"""Entity tables and run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.dates import parse_timestamp


def scan_entities(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A stored entity table, read with its fixed schema (nothing is inferred)."""
    return spark.read.schema(schemas.ENTITIES[table]).parquet(path)


def scan_metrics_csv(spark: SparkSession, path: str, report: str) -> DataFrame:
    """A run report in CSV: ``summary``, ``memory`` or ``errors``. Quoted fields may span lines."""
    schema = {
        "summary": schemas.RUN_SUMMARY,
        "memory": schemas.RUN_MEMORY,
        "errors": schemas.RUN_ERRORS,
    }[report]
    rows = spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"')
    if "timestamp" in rows.columns:
        rows = rows.withColumn("timestamp", parse_timestamp(F.col("timestamp"), "timestamp_ntz"))
    return rows


def location_dim(rows: DataFrame, column: str = "value") -> DataFrame:
    """JSON objects ``{location: entry}`` to one row per location.

    An entry is ``[country, region]`` or ``{"country_code": …, "region": …}``; anything else,
    null included, is a location known to have no country.
    """
    entry = F.explode(F.from_json(F.col(column), "map<string,string>")).alias("location", "entry")
    listed = F.from_json("entry", "array<string>")
    keyed = F.from_json("entry", "struct<country_code: string, region: string>")
    is_pair = F.col("entry").startswith("[") & (F.size(listed) == 2)
    is_keyed = F.col("entry").startswith("{")

    def field(position: int, name: str):
        return (
            F.when(is_pair, F.get(listed, F.lit(position)))
            .when(is_keyed, keyed.getField(name))
            .alias(name)
        )

    return rows.select(entry).select("location", field(0, "country_code"), field(1, "region"))


def scan_location_dim(spark: SparkSession, path: str) -> DataFrame:
    """Location files of one JSON object each, pretty-printed or not."""
    return location_dim(spark.read.text(path, wholetext=True))
