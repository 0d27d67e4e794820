"""Writes by key, as new snapshots.

A merge is a left join of the stored rows with the updates plus the updates that match nothing.
When the updates are small Spark broadcasts them and the stored table is not shuffled at all.
Updates are first reduced to one row per key by an aggregate that combines map-side, so a key that
is delivered very often does not gather in one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import parse_timestamp
from .events import SUMS, moment
from .normalize import has_key, records

REPOSITORY_COLUMNS = {
    "name": "string",
    "full_name": "string",
    "description": "string",
    "homepage": "string",
    "language": "string",
    "private": "boolean",
    "fork": "boolean",
    "default_branch": "string",
    "size": "int",
    "stargazers_count": "bigint",
    "watchers_count": "bigint",
    "forks_count": "bigint",
    "open_issues_count": "bigint",
}
REPOSITORY_TIMES = ["created_at", "updated_at", "pushed_at"]
INSERT_DEFAULTS = {
    "private": False,
    "fork": False,
    "stargazers_count": 0,
    "watchers_count": 0,
    "forks_count": 0,
    "open_issues_count": 0,
}


def first_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row with the lowest order value of every key.

    Rows without an order value come last, and equal ones are told apart by a hash of the whole row, so
    the same row wins in every run.
    """
    rest = [name for name in df.columns if name not in keys]
    place = F.struct(order.isNull(), order, F.xxhash64(*df.columns))
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), place).alias("_row"))
        .select(*keys, *[F.col(f"_row.{name}").alias(name) for name in rest])
        .select(*df.columns)
    )


def insert_missing(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows, plus the new ones whose key is not stored; stored rows never change."""
    fresh = new.join(stored.select(*keys), keys, "left_anti")
    return stored.unionByName(fresh, allowMissingColumns=True)


# ---- repositories ----------------------------------------------------------------------------
def repository_updates(rows: DataFrame, column: str = "json", order: str = "seq", time_type: str = "timestamp") -> DataFrame:
    """JSON records to one update per repository id.

    Each field is a struct where some record named it (its value may be null) and null where none
    did; the last record naming a field wins. Times count only where they can be read. The owner
    is that of the first record.
    """
    schema = ", ".join(
        ["id: bigint, owner_id: bigint, organization_id: bigint"]
        + [f"{key}: {kind}" for key, kind in REPOSITORY_COLUMNS.items()]
        + [f"{key}: string" for key in REPOSITORY_TIMES]
        + ["owner: struct<id: bigint>, organization: struct<id: bigint>"]
    )

    def named(key: str) -> Column:
        value = F.struct(F.col(f"r.{key}").alias("v"))
        return F.when(F.col(f"r.{key}").isNotNull() | has_key(key), value).alias(key)

    def readable(key: str) -> Column:
        value = parse_timestamp(F.col(f"r.{key}"), time_type)
        return F.when(value.isNotNull(), F.struct(value.alias("v"))).alias(key)

    def owner_of(key: str) -> Column:
        return F.coalesce(f"r.{key}_id", f"r.{key}.id").alias(f"{key}_id")

    fields = [*REPOSITORY_COLUMNS, *REPOSITORY_TIMES]
    parsed = (
        records(rows, column, schema, order)
        .select(
            F.col(order).alias("_order"),
            "r.id",
            *[named(key) for key in REPOSITORY_COLUMNS],
            *[readable(key) for key in REPOSITORY_TIMES],
            owner_of("owner"),
            owner_of("organization"),
        )
        .where(F.col("id").isNotNull())
    )
    last = [
        F.max_by(key, F.when(F.col(key).isNotNull(), F.col("_order"))).alias(key) for key in fields
    ]
    return (
        parsed.groupBy("id")
        .agg(*last, F.min_by(F.struct("owner_id", "organization_id"), "_order").alias("_owner"))
        .select("id", *fields, "_owner.owner_id", "_owner.organization_id")
    )


def upsert_repositories(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """Stored repositories with the updates of :func:`repository_updates` applied.

    Existing rows take the named fields and keep their owner; new rows get defaults.
    """
    fields = [name for name in stored.columns if name in REPOSITORY_COLUMNS or name in REPOSITORY_TIMES]
    changes = updates.select("id", F.lit(True).alias("_hit"), *[F.col(n).alias(f"_{n}") for n in fields])
    changed = stored.join(changes, "id", "left").select(
        *[
            F.when(F.col(f"_{name}").isNotNull(), F.col(f"_{name}.v")).otherwise(F.col(name)).alias(name)
            if name in fields
            else F.col(name)
            for name in stored.columns
        ]
    )

    def inserted(name: str) -> Column:
        if name not in fields:
            return F.col(name)
        default = F.lit(INSERT_DEFAULTS.get(name)).cast(stored.schema[name].dataType)
        return F.when(F.col(name).isNotNull(), F.col(f"{name}.v")).otherwise(default).alias(name)

    fresh = updates.join(stored.select("id"), "id", "left_anti").select(
        *[inserted(name) for name in stored.columns]
    )
    return changed.unionByName(fresh)


# ---- accounts and links -----------------------------------------------------------------------
def insert_contributors(stored: DataFrame, new: DataFrame, order: str) -> DataFrame:
    """Adds accounts with unknown ids (of several the first by ``order``); stored accounts stay as they are."""
    return insert_missing(stored, first_per_key(new, ["id"], F.col(order)), ["id"])


def insert_organizations(
    stored: DataFrame, new: DataFrame, order: str, description_as_bio: bool = False
) -> DataFrame:
    if description_as_bio:
        new = new.withColumnRenamed("description", "bio")
    return insert_contributors(stored, new, order)


def link_contributor_repo(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Adds unknown (contributor, repository) pairs; contributions are 0 where not given."""
    keys = ["contributor_id", "repository_id"]
    first = new.groupBy(*keys).agg(F.min("contributions").alias("contributions"))
    return insert_missing(stored, first.na.fill(0, ["contributions"]), keys)


def link_contributor_org(stored: DataFrame, new: DataFrame, as_of: datetime) -> DataFrame:
    """Adds unknown (contributor, organization) pairs, joined at ``as_of``."""
    keys = ["contributor_id", "organization_id"]
    kind = stored.schema["joined_at"].dataType
    pairs = new.select(*keys).distinct().withColumn("joined_at", F.lit(moment(as_of)).cast(kind))
    return insert_missing(stored, pairs, keys)


# ---- statistics ---------------------------------------------------------------------------------
def _replace_metrics(stored: DataFrame, fresh: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """One full outer join: metrics from the fresh row where there is one, the rest from the stored row."""
    others = [name for name in stored.columns if name not in keys]
    old = stored.select(*keys, F.struct(*others).alias("_old"))
    new = fresh.select(*keys, F.struct(*others).alias("_new"))

    def chosen(name: str) -> Column:
        first, second = ("_new", "_old") if name in metrics else ("_old", "_new")
        return F.when(F.col(first).isNotNull(), F.col(f"{first}.{name}")).otherwise(F.col(f"{second}.{name}"))

    merged = old.join(new, keys, "full_outer")
    return merged.select(*[F.col(name) if name in keys else chosen(name).alias(name) for name in stored.columns])


def upsert_org_yearly_stats(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """By (year, organization): metrics replaced (commits 0 where unknown), place kept."""
    fresh = fresh.withColumn("number_commits", F.coalesce("number_commits", F.lit(0)))
    return _replace_metrics(stored, fresh, ["year", "organization_id"], SUMS)


def upsert_country_yearly_stats(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """By (year, country): metrics replaced, region kept."""
    return _replace_metrics(stored, fresh, ["year", "country_code"], [*SUMS, "number_organizations"])
