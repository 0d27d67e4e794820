"""CSV exports.

Exports are folders of part files written in parallel; ordered exports are range-sorted, so the
part files in name order hold the rows in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..schemas import ENTITIES


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def store_entity(df: DataFrame, path: str, table: str) -> str:
    """Writes an entity table as parquet in its fixed schema; columns the input lacks are null."""
    columns = [
        (F.col(field.name) if field.name in df.columns else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in T.StructType.fromDDL(ENTITIES[table]).fields
    ]
    df.select(*columns).write.mode("overwrite").parquet(path)
    return path


def export_table_csv(df: DataFrame, folder: str, table: str) -> str:
    """All columns of a table to ``<folder>/<table>.csv``."""
    return _write_csv(df, f"{folder}/{table}.csv")


def export_all_tables(
    spark: SparkSession, folder: str, tables: list[str] | None = None
) -> DataFrame:
    """Exports the named (else all) tables and temporary views of the session's catalog; returns
    (table, path, row_count). Rows are counted as they are written, so a table is evaluated once."""
    names = tables or [found.name for found in spark.catalog.listTables()]
    report = []
    for name in names:
        written = Observation()
        counted = spark.table(name).observe(written, F.count(F.lit(1)).alias("row_count"))
        report.append((name, export_table_csv(counted, folder, name), written.get["row_count"]))
    return spark.createDataFrame(report, "table string, path string, row_count long")


def organization_export(stats: DataFrame, organizations: DataFrame) -> DataFrame:
    """Yearly organization statistics under the export's header, ordered by year and login."""
    logins = organizations.select(F.col("id").alias("organization_id"), "login")
    return (
        stats.join(logins, "organization_id")
        .orderBy("year", "login")
        .select(
            F.col("year").alias("Jahr"),
            F.col("login").alias("Organization"),
            F.col("location").alias("Location"),
            F.col("country_code").alias("Country"),
            F.col("region").alias("Region"),
            F.col("forks").alias("Forks"),
            F.col("stars").alias("Stars"),
            F.col("number_repos").alias("Number Repos"),
            F.col("number_commits").alias("Number Commits"),
            F.col("number_contributors").alias("Contributors"),
        )
    )


def country_export(stats: DataFrame) -> DataFrame:
    """Yearly country statistics under the export's header, ordered by year and country."""
    return stats.orderBy("year", "country_code").select(
        F.col("year").alias("Jahr"),
        F.col("country_code").alias("Country"),
        F.col("region").alias("Region"),
        F.col("forks").alias("Forks"),
        F.col("stars").alias("Stars"),
        F.col("number_repos").alias("Number Repos"),
        F.col("number_commits").alias("Number Commits"),
        F.col("number_organizations").alias("Organization Count"),
        F.col("number_contributors").alias("Contributor Count"),
    )


def export_org_stats(stats: DataFrame, organizations: DataFrame, path: str) -> str:
    return _write_csv(organization_export(stats, organizations), path)


def export_country_stats(stats: DataFrame, path: str) -> str:
    return _write_csv(country_export(stats), path)


def export_stats_bundle(
    org_stats: DataFrame, organizations: DataFrame, country_stats: DataFrame, folder: str
) -> tuple[str, str]:
    """Both statistics exports in one folder."""
    return (
        export_org_stats(org_stats, organizations, f"{folder}/organization_stats.csv"),
        export_country_stats(country_stats, f"{folder}/country_stats.csv"),
    )


def export_query_csv(result: DataFrame, path: str) -> str:
    """A report result: repository rows or (organization, repo_count) rows, told by their columns."""
    if "repo_count" in result.columns:
        wanted = ["id", "login", "name", "location", "repo_count"]
        shape = result.select(*_present(result, wanted))
    elif "full_name" in result.columns:
        renamed = result.withColumnsRenamed({"stargazers_count": "stars", "forks_count": "forks"})
        wanted = ["id", "full_name", "description", "language", "stars", "forks", "created_at", "updated_at"]
        shape = renamed.select(*_present(renamed, wanted))
    else:
        raise ValueError(f"no export shape for columns {result.columns}")
    return _write_csv(shape, path)


def _present(df: DataFrame, wanted: list[str]):
    """The wanted columns in order; one the input lacks is written empty."""
    return [
        F.col(name) if name in df.columns else F.lit(None).cast("string").alias(name)
        for name in wanted
    ]
