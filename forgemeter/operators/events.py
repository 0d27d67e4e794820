"""Aggregates over the nested event archive.

Distinct counts become partial aggregates on (group, value) before any shuffle, so one hot
organization is spread over as many tasks as it has distinct repositories and actors; the only
shuffles are those of the aggregates themselves.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from .skew import dealt

ORG = "repo.organization.login"
STATS_TYPES = ["ForkEvent", "WatchEvent", "PushEvent"]


def moment(when: datetime) -> str:
    """A bound as text; Spark reads it as the type of the column it is compared with."""
    return when.isoformat(sep=" ")


def in_days(events: DataFrame, since: str, until: str) -> DataFrame:
    """Events with created_at in [since, until]; on the archive also prunes its day partitions.

    A date without time is midnight, so ``until='2023-12-31'`` leaves out the rest of that day.
    """
    if "day" in events.columns:
        first, last = (text[:10].replace("-", "") for text in (since, until))
        events = events.where(F.col("day").between(first, last))
    return events.where((F.col("created_at") >= since) & (F.col("created_at") <= until))


def in_years(events: DataFrame, start_year: int, end_year: int) -> DataFrame:
    return in_days(events, f"{start_year}-01-01", f"{end_year}-12-31")


def _of_orgs(events: DataFrame) -> DataFrame:
    return events.where(F.col(ORG).isNotNull())


def _year() -> Column:
    return F.year("created_at").cast("bigint").alias("year")


def _login() -> Column:
    return F.col(ORG).alias("organization_login")


def _is(kind: str) -> Column:
    return F.col("type") == kind


def org_yearly_stats(
    events: DataFrame, start_year: int = 2015, end_year: int = 2023, tasks: int | None = None
) -> DataFrame:
    """Per year and organization: repositories, forks, stars and contributors.

    ``tasks``: see :func:`merged_parts`; for tables that outgrow the session's shuffle partitions.
    """
    return merged_parts(org_yearly_parts(events, start_year, end_year), tasks)


def org_yearly_parts(events: DataFrame, start_year: int = 2015, end_year: int = 2023) -> DataFrame:
    """What :func:`merged_parts` makes :func:`org_yearly_stats` of: distinct ids with their counts."""
    rows = _of_orgs(in_years(events, start_year, end_year)).where(F.col("type").isin(STATS_TYPES))
    return rows.groupBy(
        _year(), _login(), F.col("repo.id").alias("repo_id"), F.col("actor.id").alias("actor_id")
    ).agg(F.count_if(_is("ForkEvent")).alias("forks"), F.count_if(_is("WatchEvent")).alias("stars"))


def fewer_parts(parts: DataFrame) -> DataFrame:
    """Rows of several outputs of :func:`org_yearly_parts` as one output of all their events."""
    return parts.groupBy("year", "organization_login", "repo_id", "actor_id").agg(
        F.sum("forks").alias("forks"), F.sum("stars").alias("stars")
    )


def merged_parts(parts: DataFrame, tasks: int | None = None) -> DataFrame:
    """The yearly statistics of all events that the parts were made from.

    Every distinct id is one row of its (year, organization); the two kinds share one shuffle, into ``tasks`` tasks where that is given.
    """
    group = ["year", "organization_login"]
    none = F.lit(0).cast("bigint")
    kinds = F.array(
        F.struct(F.lit(True).alias("is_repo"), F.col("repo_id").alias("id"), "forks", "stars"),
        F.struct(F.lit(False).alias("is_repo"), F.col("actor_id").alias("id"), none.alias("forks"), none.alias("stars")),
    )
    ids = dealt(parts.select(*group, F.inline(kinds)), tasks, *group, "is_repo", "id")
    sums = [F.sum(name).alias(name) for name in ("forks", "stars")]
    return ids.groupBy(*group, "is_repo", "id").agg(*sums).groupBy(*group).agg(
        F.count(F.when(F.col("is_repo"), F.col("id"))).alias("number_repos"),
        *sums,
        F.count(F.when(~F.col("is_repo"), F.col("id"))).alias("number_contributors"),
    )


def org_yearly_commits(
    events: DataFrame, start_year: int = 2015, end_year: int = 2023, tasks: int | None = None
) -> DataFrame:
    """Per year and organization: distinct commit hashes of pushes.

    With ``tasks`` the hashes of each repository are made distinct first, which shuffles nothing where the events are dealt out by
    repository, and those that are left are dealt out into so many tasks.
    """
    pushes = _of_orgs(in_years(events, start_year, end_year)).where(
        _is("PushEvent") & F.col("payload.commits").isNotNull()
    )
    group = ["year", "organization_login"]
    hashes = pushes.select(_year(), _login(), F.col("repo.id").alias("repo_id"), F.explode_outer("payload.commits.sha").alias("sha"))
    if tasks is None:
        return hashes.groupBy(*group).agg(F.count_distinct("sha").alias("number_commits"))
    distinct = dealt(hashes.distinct().select(*group, "sha"), tasks, *group, "sha").distinct()
    return distinct.groupBy(*group).agg(F.count("sha").alias("number_commits"))


PUSH_METRICS = ["number_repos", "forks", "stars", "contributors", "number_commits"]


def org_yearly_stats_push(
    events: DataFrame,
    start_year: int,
    end_year: int,
    as_of: datetime | None = None,
    metrics: list[str] | None = None,
) -> DataFrame:
    """Variant over all event types: contributors are pushing logins, commits are push events.

    ``as_of`` clamps the last year to its own; a shorter ``metrics`` list reads fewer columns.
    """
    if as_of is not None:
        end_year = min(end_year, as_of.year)
    available = {
        "number_repos": F.count_distinct("repo.id"),
        "forks": F.count_if(_is("ForkEvent")),
        "stars": F.count_if(_is("WatchEvent")),
        "contributors": F.count_distinct(F.when(_is("PushEvent"), F.col("actor.login"))),
        "number_commits": F.count_distinct(F.when(_is("PushEvent"), F.col("id"))),
    }
    chosen = [available[name].alias(name) for name in metrics or PUSH_METRICS]
    return _of_orgs(in_years(events, start_year, end_year)).groupBy(_year(), _login()).agg(*chosen)


def org_yearly_simple(events: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """The two cheapest metrics only: repositories and stars."""
    return org_yearly_stats_push(events, start_year, end_year, metrics=["number_repos", "stars"])


def enrich_with_organizations(stats: DataFrame, organizations: DataFrame) -> DataFrame:
    """Adds id, location, country and region; rows of unknown logins drop out."""
    known = organizations.select(
        F.col("login").alias("organization_login"),
        F.col("id").alias("organization_id"),
        "location",
        "country_code",
        "region",
    )
    return stats.join(known, "organization_login")


def unknown_organizations(stats: DataFrame, organizations: DataFrame) -> DataFrame:
    """The rows :func:`enrich_with_organizations` drops."""
    known = organizations.select(F.col("login").alias("organization_login"))
    return stats.join(known, "organization_login", "left_anti")


def backfill_commits(stats: DataFrame, commits: DataFrame) -> DataFrame:
    """Sets number_commits of existing (year, organization) rows, 0 where none is known."""
    found = commits.withColumnRenamed("number_commits", "_commits")
    kept = [F.col(name) for name in stats.columns if name != "number_commits"]
    return stats.join(found, ["year", "organization_login"], "left").select(
        *kept, F.coalesce("_commits", F.lit(0)).cast("bigint").alias("number_commits")
    )


def organization_statistics(
    events: DataFrame,
    organizations: DataFrame,
    start_year: int = 2015,
    end_year: int = 2023,
    tasks: int | None = None,
) -> DataFrame:
    """The stored yearly table: statistics with commits and organization attributes."""
    stats = org_yearly_stats(events, start_year, end_year, tasks)
    commits = org_yearly_commits(events, start_year, end_year, tasks)
    return enrich_with_organizations(backfill_commits(stats, commits), organizations).select(
        "year",
        "organization_id",
        "location",
        "country_code",
        "region",
        "forks",
        "stars",
        "number_repos",
        "number_commits",
        "number_contributors",
    )


SUMS = ["forks", "stars", "number_repos", "number_commits", "number_contributors"]


def country_yearly_stats(
    org_stats: DataFrame, start_year: int = 2015, end_year: int = 2023
) -> DataFrame:
    """Per year and country: summed organization statistics.

    ``org_stats`` has one row per year and organization. Contributors are summed per organization, so a person active in two counts twice. Where a
    country occurs under several regions, in order (none first, then by name): the metrics are
    those of the last region, the region label is the first.
    """
    rows = org_stats.where(
        F.col("year").between(start_year, end_year)
        & F.col("country_code").isNotNull()
        & (F.col("country_code") != "")
    )
    per_region = rows.groupBy("year", "country_code", "region").agg(
        *[F.sum(name).alias(name) for name in SUMS],
        F.count("organization_id").alias("number_organizations"),
    )
    order = F.coalesce("region", F.lit(""))
    names = SUMS[:4] + ["number_organizations"] + SUMS[4:]
    return (
        per_region.groupBy("year", "country_code")
        .agg(F.min_by("region", order).alias("region"), F.max_by(F.struct(*names), order).alias("m"))
        .select("year", "country_code", "region", *[F.col(f"m.{name}") for name in names])
    )


def country_input_stats(
    events: DataFrame, organizations: DataFrame, start_year: int, end_year: int
) -> DataFrame:
    """Country statistics built on the push variant of the organization statistics."""
    stats = org_yearly_stats_push(events, start_year, end_year).withColumnRenamed(
        "contributors", "number_contributors"
    )
    return country_yearly_stats(
        enrich_with_organizations(stats, organizations), start_year, end_year
    )


def repo_metrics(events: DataFrame, full_name: str, until: datetime, since: datetime | None = None) -> DataFrame:
    """One row for one repository over [since, until], by default the last day; zeros when nothing happened."""
    since = until - timedelta(days=1) if since is None else since
    rows = in_days(events, moment(since), moment(until)).where(
        F.col("repo.name") == full_name
    )
    login = F.col("actor.login")
    return rows.agg(
        F.count_distinct(F.when(_is("WatchEvent"), login)).alias("stars"),
        F.count_distinct(F.when(_is("PushEvent"), login)).alias("contributors"),
        F.count_distinct(F.when(_is("PushEvent"), F.col("id"))).alias("commits"),
    )


def event_projection(events: DataFrame) -> DataFrame:
    return events.select(
        "id",
        "type",
        F.col("actor.login").alias("actor_login"),
        F.col("repo.name").alias("repo_name"),
        "created_at",
    )


def repo_events(
    events: DataFrame,
    full_name: str,
    until: datetime,
    since: datetime | None = None,
    event_types: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The events of one repository in [since, until], by default the last day; at most ``limit``, the first ones."""
    since = until - timedelta(days=1) if since is None else since
    rows = in_days(events, moment(since), moment(until)).where(F.col("repo.name") == full_name)
    if event_types:
        rows = rows.where(F.col("type").isin(event_types))
    found = event_projection(rows)
    return found if limit is None else found.orderBy("created_at", "id").limit(limit)


def flatten(events: DataFrame) -> DataFrame:
    """Archive events in the flat form the reports use."""
    return events.select(
        "id", "created_at", F.col("actor.id").alias("actor_id"), F.col("repo.id").alias("repo_id"), "type"
    )


def daily_event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy(F.to_date("created_at").alias("date")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


BUCKETS = {"hour": "1 hour", "day": "1 day"}


def events_per_bucket(events: DataFrame, resolution: str = "hour") -> DataFrame:
    """Events per tumbling bucket and type; the same for a batch and a watermarked stream."""
    return (
        events.groupBy(F.window("created_at", BUCKETS[resolution]).alias("w"), "type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.col("w.start").alias("bucket_start"), "type", "event_count")
    )
