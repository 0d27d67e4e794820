"""Analyses across people, places, repositories and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .skew import join_heavy


def _home(contributors: DataFrame) -> DataFrame:
    return contributors.where(F.col("country_code").isNotNull()).select(
        F.col("id").alias("contributor_id"), "country_code", "region"
    )


def country_contributions(links: DataFrame, contributors: DataFrame) -> DataFrame:
    """People and contributions per country and region."""
    per_person = links.groupBy("contributor_id").agg(F.sum("contributions").alias("_n"))
    return (
        per_person.join(_home(contributors), "contributor_id")
        .groupBy("country_code", "region")
        .agg(F.count(F.lit(1)).alias("contributors"), F.sum("_n").alias("contributions"))
    )


def emerging_hubs(country_stats: DataFrame) -> DataFrame:
    """Change of a country's contributors against its previous year on record.

    A window partition holds one row per year.
    """
    by_year = W.partitionBy("country_code").orderBy("year")
    before = F.lag("number_contributors").over(by_year)
    return country_stats.select("country_code", "year", "number_contributors", before.alias("previous")).select(
        "country_code",
        "year",
        "number_contributors",
        (F.col("number_contributors") - F.col("previous")).alias("growth"),
        F.try_divide(F.col("number_contributors") - F.col("previous"), F.col("previous")).alias("growth_rate"),
    )


def org_geo_spread(repositories: DataFrame, links: DataFrame, contributors: DataFrame) -> DataFrame:
    """Contributors and their countries per organization."""
    owned = repositories.where(F.col("organization_id").isNotNull()).select(
        F.col("id").alias("repository_id"), "organization_id"
    )
    people = join_heavy(links.select("repository_id", "contributor_id"), owned, "repository_id")
    people = people.select("organization_id", "contributor_id").distinct()
    return (
        join_heavy(people, _home(contributors), "contributor_id", "left")
        .groupBy("organization_id")
        .agg(
            F.count(F.lit(1)).alias("contributors"),
            F.count_distinct("country_code").alias("countries"),
        )
    )


def _repo_countries(links: DataFrame, contributors: DataFrame) -> DataFrame:
    """Distinct (repository, country); at most the ~250 country codes per repository."""
    return (
        join_heavy(links.select("repository_id", "contributor_id"), _home(contributors), "contributor_id")
        .select("repository_id", "country_code")
        .distinct()
    )


def cross_border_pairs(links: DataFrame, contributors: DataFrame) -> DataFrame:
    """Shared repositories per pair of countries.

    Repositories with the same set of countries are counted together first, and pairs come from
    the distinct sets only. A set holds country codes, so its size has a fixed bound.
    """
    sets = (
        _repo_countries(links, contributors)
        .groupBy("repository_id")
        .agg(F.array_sort(F.collect_set("country_code")).alias("countries"))
        .where(F.size("countries") > 1)
        .groupBy("countries")
        .agg(F.count(F.lit(1)).alias("_repos"))
    )
    firsts = sets.select("_repos", "countries", F.posexplode("countries").alias("at", "country_a"))
    later = F.expr("slice(countries, at + 2, size(countries))")
    return (
        firsts.select("_repos", "country_a", F.explode(later).alias("country_b"))
        .groupBy("country_a", "country_b")
        .agg(F.sum("_repos").alias("shared_repositories"))
    )


def repo_diversity(links: DataFrame, contributors: DataFrame) -> DataFrame:
    """Number of countries per repository."""
    return _repo_countries(links, contributors).groupBy("repository_id").agg(
        F.count(F.lit(1)).alias("countries")
    )


def language_by_region(repositories: DataFrame, contributors: DataFrame) -> DataFrame:
    """Languages of the repositories owned in each region, with their share.

    Owners are counted by language before the join; a window partition holds one region's languages.
    """
    used = F.col("language").isNotNull() & (F.col("language") != "")
    per_owner = (
        repositories.where(used).groupBy(F.col("owner_id").alias("contributor_id"), "language")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counts = (
        per_owner.join(_home(contributors).where(F.col("region").isNotNull()), "contributor_id")
        .groupBy("region", "language")
        .agg(F.sum("_n").alias("repositories"))
    )
    whole = F.sum("repositories").over(W.partitionBy("region"))
    return counts.withColumn("share", F.col("repositories") / whole)


def language_trend(repositories: DataFrame) -> DataFrame:
    """New repositories per year and language."""
    used = F.col("language").isNotNull() & (F.col("language") != "")
    return (
        repositories.where(used)
        .groupBy(F.year("created_at").cast("bigint").alias("year"), "language")
        .agg(F.count(F.lit(1)).alias("repositories"))
    )


def key_contributors(links: DataFrame, contributors: DataFrame, limit: int = 10) -> DataFrame:
    """People by number of repositories, then contributions."""
    impact = links.groupBy("contributor_id").agg(
        F.count_distinct("repository_id").alias("repositories"),
        F.sum("contributions").alias("contributions"),
    )
    top = impact.join(
        contributors.select(F.col("id").alias("contributor_id"), "login"), "contributor_id"
    )
    return top.orderBy(F.desc("repositories"), F.desc("contributions"), "contributor_id").limit(limit)


def contribution_span(events: DataFrame) -> DataFrame:
    """First and last contribution and their number per person and repository."""
    return events.groupBy(
        F.col("actor_id").alias("contributor_id"), F.col("repo_id").alias("repository_id")
    ).agg(
        F.count(F.lit(1)).alias("contributions"),
        F.min("created_at").alias("first_contribution_at"),
        F.max("created_at").alias("last_contribution_at"),
    )
