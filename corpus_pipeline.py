"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from forgemeter.llm import decontamination, language_id, line_dedup, mixing, simhash
from forgemeter.llm.common import stored, table, unpacked


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those too far from every centroid go."""
    return language_id.known_language(docs)


def dedupe_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines copied from an earlier document are cut; documents that lose all their lines go."""
    cut = line_dedup.cut_lines(docs).filter("n_deleted = 0 OR n_deleted < n_lines")
    return cut.select(*unpacked(docs, "row", {"text": F.col("text")}))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the words taken and the places of their pieces."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedupe_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: Centroids, patience diff and XXH64 shingles are beyond DuckDB's SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
