"""Reports over entity tables and flat events.

Event counts are aggregated by their join key *before* any join, so a repository or actor holding
a third of all events reaches the join as one row. Top-k reports end their order with a key.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions import fixed_values as V
from .events import moment
from .skew import join_heavy

ROWS = "*"


# ---- lookups and filters -----------------------------------------------------------------------
def lookup_by_id(entities: DataFrame, entity_id: int) -> DataFrame:
    return entities.where(F.col("id") == entity_id).limit(1)


def lookup_by_name(entities: DataFrame, name: str, column: str = "login") -> DataFrame:
    """By ``login`` (accounts) or ``full_name`` (repositories)."""
    return entities.where(F.col(column) == name).limit(1)


def lookup_owner_name(repositories: DataFrame, owner: str, name: str) -> DataFrame:
    return lookup_by_name(repositories, f"{owner}/{name}", "full_name")


def non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def recent_events(events: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    return events.where(F.col("created_at") >= moment(as_of - timedelta(days=days)))


def created_within(df: DataFrame, window: tuple | None) -> DataFrame:
    """Rows created in [first, last) days; everything where there is no window."""
    if window is None:
        return df
    first, last = (str(bound) for bound in window)
    return df.where((F.col("created_at") >= first) & (F.col("created_at") < last))


SORT_COLUMNS = {"stars": "stargazers_count", "forks": "forks_count", "updated": "updated_at"}


def sorted_by(sort: str = "stars", order: str = "desc") -> list[Column]:
    column = F.col(SORT_COLUMNS[sort])
    return [column.desc_nulls_last() if order == "desc" else column.asc_nulls_last(), F.col("id")]


def search_repos(
    repositories: DataFrame,
    min_stars: int | None = None,
    max_stars: int | None = None,
    min_forks: int | None = None,
    created_after: str | None = None,
    created_before: str | None = None,
    language: str | None = None,
    sort: str = "stars",
    order: str = "desc",
    per_page: int = 100,
    page: int = 1,
    max_results: int | None = None,
) -> DataFrame:
    """Typed repository search: one page of results, or the first ``max_results`` from that page on."""
    found = matching_repos(repositories, min_stars, max_stars, min_forks, created_after, created_before, language)
    ranked = found.orderBy(*sorted_by(sort, order))
    skipped = (page - 1) * per_page
    if skipped:
        ranked = ranked.offset(skipped)
    return ranked.limit(per_page if max_results is None else max_results)


def matching_repos(
    repositories: DataFrame,
    min_stars: int | None = None,
    max_stars: int | None = None,
    min_forks: int | None = None,
    created_after: str | None = None,
    created_before: str | None = None,
    language: str | None = None,
) -> DataFrame:
    """All repositories a search finds; days are inclusive, languages compare without case."""
    found = repositories
    if min_stars is not None:
        found = found.where(F.col("stargazers_count") >= min_stars)
    if max_stars is not None:
        found = found.where(F.col("stargazers_count") <= max_stars)
    if min_forks is not None:
        found = found.where(F.col("forks_count") >= min_forks)
    if created_after is not None:
        found = found.where(F.col("created_at") >= created_after)
    if created_before is not None:
        after = str(datetime.fromisoformat(created_before) + timedelta(days=1))
        found = found.where(F.col("created_at") < after)
    if language is not None:
        found = found.where(F.lower("language") == language.lower())
    return found


def search_repos_since(
    repositories: DataFrame,
    min_stars: int = 10,
    created_after: str = "2014-01-01",
    language: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Repositories created since a day, best first up to ``limit``; all of them without one."""
    wanted = {"min_stars": min_stars, "created_after": created_after, "language": language}
    if limit is None:
        return matching_repos(repositories, **wanted)
    return search_repos(repositories, **wanted, max_results=limit)


def select_repos(
    repositories: DataFrame,
    events: DataFrame | None = None,
    repo_ids: list[int] | DataFrame | None = None,
    repo_names: list[str] | DataFrame | None = None,
    event_types: list[str] | None = None,
    min_stars: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Repositories by id or full name (lists, or frames with an ``id`` / ``full_name`` column),
    with at least one event of the given types, and enough stars; most stars first."""
    found = repositories
    if isinstance(repo_ids, DataFrame) or isinstance(repo_names, DataFrame):
        parts = []
        for key, wanted in (("id", repo_ids), ("full_name", repo_names)):
            if isinstance(wanted, DataFrame):
                parts.append(repositories.join(wanted.select(key), key, "left_semi").select("id"))
            elif wanted is not None:
                parts.append(repositories.where(F.col(key).isin(wanted)).select("id"))
        chosen = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        found = found.join(chosen, "id", "left_semi")
    else:
        tests = [
            F.col(key).isin(wanted)
            for key, wanted in (("id", repo_ids), ("full_name", repo_names))
            if wanted is not None
        ]
        if tests:
            found = found.where(tests[0] if len(tests) == 1 else tests[0] | tests[1])
    if min_stars is not None:
        found = found.where(F.col("stargazers_count") >= min_stars)
    if event_types is not None:
        active = (
            events.where(F.col("type").isin(event_types)).select(F.col("repo_id").alias("id")).distinct()
        )
        found = found.join(active, "id", "left_semi")
    return found if limit is None else found.orderBy(*sorted_by()).limit(limit)


def commits_last_year(events: DataFrame, as_of: datetime, days: int = 365) -> DataFrame:
    """Push events per repository in the year before ``as_of``."""
    return (
        recent_events(events, as_of, days)
        .where(F.col("type") == "PushEvent")
        .groupBy("repo_id")
        .agg(F.count_distinct("id").alias("commits_last_year"))
    )


def repo_contributor_count(links: DataFrame) -> DataFrame:
    return links.groupBy("repository_id").agg(
        F.count_distinct("contributor_id").alias("contributors_count")
    )


def quality_repos_filter(
    repositories: DataFrame,
    events: DataFrame,
    links: DataFrame,
    as_of: datetime,
    min_stars: int = 50,
    min_forks: int = 10,
    min_commits_last_year: int = 100,
    min_contributors: int = 3,
) -> DataFrame:
    """Repositories above all four thresholds, with their commits and contributors.

    Each activity table is cut to its own threshold before the joins.
    """
    commits = commits_last_year(events, as_of).where(F.col("commits_last_year") >= min_commits_last_year)
    people = repo_contributor_count(links).where(F.col("contributors_count") >= min_contributors)
    popular = repositories.where(
        (F.col("stargazers_count") >= min_stars) & (F.col("forks_count") >= min_forks)
    )
    how = ["inner" if least > 0 else "left" for least in (min_commits_last_year, min_contributors)]
    return (
        popular.join(commits.withColumnRenamed("repo_id", "id"), "id", how[0])
        .join(people.withColumnRenamed("repository_id", "id"), "id", how[1])
        .na.fill(0, ["commits_last_year", "contributors_count"])
    )


# ---- joins ---------------------------------------------------------------------------------------
def new_rows_only(candidates: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """Candidates whose key is not stored yet."""
    return candidates.join(stored.select(key), key, "left_anti")


def repos_of_org(repositories: DataFrame, organizations: DataFrame, login: str) -> DataFrame:
    wanted = organizations.where(F.col("login") == login).select(F.col("id").alias("organization_id"))
    return repositories.join(wanted, "organization_id", "left_semi")


def repos_with_org(repositories: DataFrame, organizations: DataFrame) -> DataFrame:
    """Repositories of organizations with the organization's login, however many one has."""
    orgs = organizations.select(F.col("id").alias("organization_id"), F.col("login").alias("organization"))
    return join_heavy(repositories.where(F.col("organization_id").isNotNull()), orgs, "organization_id")


def org_repo_counts(organizations: DataFrame, repositories: DataFrame) -> DataFrame:
    """Every organization with its number of repositories, 0 included."""
    counts = repositories.groupBy(F.col("organization_id").alias("id")).agg(F.count("id").alias("_n"))
    return (
        organizations.select("id", "login")
        .join(counts, "id", "left")
        .select("id", "login", F.coalesce("_n", F.lit(0)).cast("bigint").alias("repository_count"))
    )


def outer_merge(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on the keys; missing counts become 0."""
    return left.join(right, keys, "full_outer").na.fill(0)


def repository_contributors(
    repositories: DataFrame, contributors: DataFrame, repo_links: DataFrame
) -> DataFrame:
    """(repository, contributor) names along the link table, for either direction."""
    people = contributors.select(F.col("id").alias("contributor_id"), F.col("login").alias("contributor"))
    repos = repositories.select(F.col("id").alias("repository_id"), F.col("full_name").alias("repository"))
    named = join_heavy(repo_links.select("contributor_id", "repository_id"), repos, "repository_id")
    return join_heavy(named, people, "contributor_id").select("repository", "contributor")


def contributor_organizations(
    contributors: DataFrame, organizations: DataFrame, org_links: DataFrame
) -> DataFrame:
    """(contributor, organization) names along the link table, for either direction."""
    people = contributors.select(F.col("id").alias("contributor_id"), F.col("login").alias("contributor"))
    orgs = organizations.select(F.col("id").alias("organization_id"), F.col("login").alias("organization"))
    named = join_heavy(org_links.select("contributor_id", "organization_id"), orgs, "organization_id")
    return join_heavy(named, people, "contributor_id").select("contributor", "organization")


# ---- distributions and coverage -------------------------------------------------------------------
def entity_counts(**tables: DataFrame) -> DataFrame:
    """(entity, row_count) for each named table."""
    counts = [
        df.agg(F.count(ROWS).alias("row_count")).select(F.lit(name).alias("entity"), "row_count")
        for name, df in tables.items()
    ]
    return _union(counts)


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def language_distribution(repositories: DataFrame) -> DataFrame:
    """Repositories per language, unnamed ('') included, most first."""
    return (
        repositories.where(F.col("language").isNotNull())
        .groupBy("language")
        .agg(F.count("id").alias("count"))
        .orderBy(F.desc("count"), "language")
    )


def language_statistics(repositories: DataFrame) -> DataFrame:
    return language_distribution(non_empty(repositories, "language"))


def top_languages(repositories: DataFrame, limit: int = 10) -> DataFrame:
    return language_distribution(repositories).limit(limit)


def repo_date_range(repositories: DataFrame) -> DataFrame:
    """One row (earliest, latest) as days; no row for an empty table."""
    ends = repositories.agg(F.min("created_at").alias("a"), F.max("created_at").alias("b"))
    return ends.where(F.col("a").isNotNull()).select(
        F.date_format("a", "yyyy-MM-dd").alias("earliest"), F.date_format("b", "yyyy-MM-dd").alias("latest")
    )


def location_coverage(accounts: DataFrame) -> DataFrame:
    """How many accounts have a location and a country; percentages are 0 without a base."""

    def filled(column: str) -> Column:
        return F.count_if(F.col(column).isNotNull() & (F.col(column) != ""))

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole) * 100).otherwise(F.lit(0.0))

    counts = accounts.agg(
        F.count(ROWS).alias("total"),
        filled("location").alias("with_location"),
        filled("country_code").alias("with_country_code"),
    )
    return counts.select(
        "*",
        share("with_location", "total").alias("location_percentage"),
        share("with_country_code", "total").alias("country_code_percentage"),
        share("with_country_code", "with_location").alias("country_code_from_location_percentage"),
    )


def database_stats(
    repositories: DataFrame, contributors: DataFrame, organizations: DataFrame
) -> DataFrame:
    """The overview report in long form: (section, name, value as text)."""

    def rows(section: str, df: DataFrame, name: Column, value: Column) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"), name.alias("name"), value.cast("string").alias("value")
        )

    def unpivoted(section: str, df: DataFrame, columns: list[str]) -> DataFrame:
        entries = F.explode(
            F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in columns])
        )
        long = df.select(entries.alias("e"))
        return rows(section, long, F.col("e.k"), F.col("e.v"))

    parts = [
        rows(
            "counts",
            entity_counts(
                repositories=repositories, contributors=contributors, organizations=organizations
            ),
            F.col("entity"),
            F.col("row_count"),
        ),
        rows(
            "languages",
            language_statistics(repositories).limit(10),
            F.col("language"),
            F.col("count"),
        ),
        unpivoted("date_range", repo_date_range(repositories), ["earliest", "latest"]),
    ]
    for section, accounts in (("contributors", contributors), ("organizations", organizations)):
        coverage = location_coverage(accounts)
        for percent in [name for name in coverage.columns if name.endswith("percentage")]:
            coverage = coverage.withColumn(percent, F.round(percent, 1))
        parts.append(unpivoted(section, coverage, coverage.columns))
    return _union(parts)


def stars_histogram(repositories: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width bins over the range of stars; the last bin is closed, empty bins count 0.

    With a single value the range is widened by one half on both sides.
    """
    stars = repositories.where(F.col("stargazers_count").isNotNull())
    value = F.col("stargazers_count").cast("double")
    spread = F.when(F.min(value) == F.max(value), 0.5).otherwise(0.0)
    ends = stars.agg(
        F.struct((F.min(value) - spread).alias("low"), (F.max(value) + spread).alias("high"))
    ).scalar()
    low, high = ends.getField("low"), ends.getField("high")
    position = F.floor((F.col("stargazers_count") - low) * bins / (high - low))
    counts = stars.groupBy(F.least(position, F.lit(bins - 1)).cast("bigint").alias("bin")).agg(
        F.count(ROWS).alias("repositories")
    )
    numbers = repositories.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return numbers.join(counts, "bin", "left").select(
        "bin",
        (low + F.col("bin") * (high - low) / bins).alias("low"),
        (low + (F.col("bin") + 1) * (high - low) / bins).alias("high"),
        F.coalesce("repositories", F.lit(0)).cast("bigint").alias("repositories"),
    )


def _width(data_type: T.DataType) -> int:
    if isinstance(data_type, (T.CharType, T.VarcharType)):
        return 0
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return V.COLUMN_WIDTHS["int"]
    if isinstance(data_type, T.BooleanType):
        return V.COLUMN_WIDTHS["boolean"]
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return V.COLUMN_WIDTHS["timestamp"]
    return V.COLUMN_WIDTHS["string"] if isinstance(data_type, T.StringType) else 0


def table_profile(**tables: DataFrame) -> DataFrame:
    """(table, rows, estimated MB) per table and one ``total`` row."""
    parts = []
    for name, df in tables.items():
        width = sum(_width(field.dataType) for field in df.schema.fields)
        parts.append(
            df.agg(F.count(ROWS).alias("rows")).select(
                F.lit(name).alias("table"), "rows", (F.col("rows") * width / (1024 * 1024)).alias("estimated_mb")
            )
        )
    whole = _union(parts)
    total = whole.agg(F.sum("rows").alias("rows"), F.sum("estimated_mb").alias("estimated_mb"))
    return whole.unionByName(total.select(F.lit("total").alias("table"), "rows", "estimated_mb"))


def sample_rows(df: DataFrame, rows: int = 5) -> DataFrame:
    """The few rows the overview prints per table."""
    return df.limit(rows)


# ---- top-k -----------------------------------------------------------------------------------------
def top_repositories(repositories: DataFrame, limit: int = 10) -> DataFrame:
    return repositories.orderBy(*sorted_by()).limit(limit)


def repos_by_language(repositories: DataFrame, language: str, limit: int = 10) -> DataFrame:
    return top_repositories(repositories.where(F.col("language") == language), limit)


def top_organizations(organizations: DataFrame, repositories: DataFrame, limit: int = 10) -> DataFrame:
    """Organizations with the most repositories, counted before the join."""
    counts = (
        repositories.where(F.col("organization_id").isNotNull())
        .groupBy("organization_id")
        .agg(F.count("id").alias("repo_count"))
    )
    orgs = organizations.withColumnRenamed("id", "organization_id")
    return (
        counts.join(orgs, "organization_id")
        .withColumnRenamed("organization_id", "id")
        .orderBy(F.desc("repo_count"), "id")
        .limit(limit)
    )


# ---- places ----------------------------------------------------------------------------------------
PLACE = ["location", "location_lat", "location_lon"]


def _events_per_place(events: DataFrame, people: DataFrame, into: str) -> DataFrame:
    per_actor = events.groupBy("actor_id").agg(F.count(ROWS).alias("_events"))
    placed = people.where(F.col("location").isNotNull()).select(F.col("id").alias("actor_id"), *PLACE)
    return per_actor.join(placed, "actor_id").groupBy(*PLACE).agg(F.sum("_events").alias(into))


def contributor_locations(events: DataFrame, contributors: DataFrame, repository_id: int) -> DataFrame:
    """Events of one repository per place of their actors."""
    own = events.where(F.col("repo_id") == repository_id)
    return _events_per_place(own, contributors, "contributor_count").orderBy(
        F.desc("contributor_count"), "location"
    )


def active_regions(
    events: DataFrame,
    contributors: DataFrame,
    as_of: datetime,
    event_type: str | None = None,
    days: int = 30,
) -> DataFrame:
    recent = recent_events(events, as_of, days)
    if event_type:
        recent = recent.where(F.col("type") == event_type)
    return _events_per_place(recent, contributors, "event_count").orderBy(
        F.desc("event_count"), "location"
    )


def organization_locations(organizations: DataFrame, repositories: DataFrame) -> DataFrame:
    """Repositories and stars per place of the organizations; stars stay null without any."""
    per_org = repositories.groupBy(F.col("organization_id").alias("id")).agg(
        F.count("id").alias("_repos"), F.sum("stargazers_count").alias("_stars")
    )
    return (
        organizations.where(F.col("location").isNotNull())
        .join(per_org, "id", "left")
        .groupBy(*PLACE)
        .agg(
            F.sum(F.coalesce("_repos", F.lit(0))).alias("repository_count"),
            F.sum("_stars").alias("total_stars"),
        )
        .orderBy(F.col("total_stars").desc_nulls_last(), "location")
    )


# ---- organizations over time -------------------------------------------------------------------------
def _org_repos(repositories: DataFrame, org_id: int | None) -> DataFrame:
    test = F.col("organization_id").isNotNull() if org_id is None else F.col("organization_id") == org_id
    return repositories.where(test)


def org_growth(
    events: DataFrame, repositories: DataFrame, as_of: datetime, days: int = 365, org_id: int | None = None
) -> DataFrame:
    """Active people and new repositories per organization and day; one or all organizations."""
    repos = _org_repos(repositories, org_id)
    owner = repos.select(F.col("id").alias("repo_id"), "organization_id")
    activity = (
        recent_events(events, as_of, days)
        .select("repo_id", "actor_id", F.to_date("created_at").alias("date"))
        .distinct()
        .join(owner, "repo_id")
        .groupBy("organization_id", "date")
        .agg(F.count_distinct("actor_id").alias("new_members"))
    )
    created = (
        recent_events(repos, as_of, days)
        .groupBy("organization_id", F.to_date("created_at").alias("date"))
        .agg(F.count("id").alias("new_repositories"))
    )
    return outer_merge(activity, created, ["organization_id", "date"])


def cumulative_growth(growth: DataFrame) -> DataFrame:
    """Running totals by date; a partition holds one row per day of one organization."""
    running = W.partitionBy("organization_id").orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    return growth.select(
        "organization_id",
        "date",
        F.sum("new_members").over(running).alias("total_members"),
        F.sum("new_repositories").over(running).alias("total_repositories"),
    )


def org_top_contributors(
    events: DataFrame, repositories: DataFrame, contributors: DataFrame, org_id: int, limit: int = 10
) -> DataFrame:
    """People with the most pushes and pull requests in one organization."""
    owned = _org_repos(repositories, org_id).select(F.col("id").alias("repo_id"))
    per_actor = (
        events.where(F.col("type").isin("PushEvent", "PullRequestEvent"))
        .groupBy("repo_id", "actor_id")
        .agg(F.count(ROWS).alias("_events"))
        .join(owned, "repo_id", "left_semi")
        .groupBy("actor_id")
        .agg(F.sum("_events").alias("_events"))
    )
    people = contributors.select(F.col("id").alias("actor_id"), "login", "location")
    return (
        per_actor.join(people, "actor_id")
        .groupBy("login", "location")
        .agg(F.sum("_events").alias("contribution_count"))
        .orderBy(F.desc("contribution_count"), "login", "location")
        .limit(limit)
    )


def repo_activity(events: DataFrame, repositories: DataFrame, org_id: int) -> DataFrame:
    """Events per repository of one organization, idle repositories included."""
    per_repo = events.groupBy(F.col("repo_id").alias("id")).agg(F.count(ROWS).alias("_events"))
    return (
        _org_repos(repositories, org_id)
        .join(per_repo, "id", "left")
        .groupBy("name", "language", "stargazers_count", "forks_count")
        .agg(F.sum(F.coalesce("_events", F.lit(0))).alias("event_count"))
        .orderBy(F.desc("event_count"), "name")
    )


# ---- collection runs ---------------------------------------------------------------------------------
def collection_by_year(progress: DataFrame) -> DataFrame:
    """Repositories found per year of the period, and one ``total`` row."""
    return (
        progress.rollup(F.substring("period", 1, 4).alias("year"))
        .agg(F.sum("num_repositories").alias("repositories"))
        .na.fill("total", ["year"])
    )


def run_success_summary(attempts: DataFrame) -> DataFrame:
    """Successful and all attempts of a run's (name, success) results."""
    return attempts.agg(F.count_if("success").alias("successful"), F.count(ROWS).alias("attempts"))
