"""Checked queries: filters, joins, reports, windows, top-k, insights, metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import events as E, geo as G, insights as X, metrics as M, reports as R
from ..sinks import tables as K
from ..sources import sample_tables as S
from ..workspace import fresh_path
from .registry import check, text, time_text

AS_OF = datetime(2024, 1, 31)
REPO = "id, full_name, stargazers_count, forks_count"
REPO_COLUMNS = REPO.split(", ")


def repos(spark, sf_dir):
    return S.repositories(spark, sf_dir)


def people(spark, sf_dir):
    return S.located(S.contributors(spark, sf_dir))


def orgs(spark, sf_dir):
    return S.located(S.organizations(spark, sf_dir))


# ---- lookups and filters ---------------------------------------------------------------------------
@check(
    "lookup_by_id",
    f"SELECT {REPO} FROM repositories WHERE id = (SELECT max(o_orderkey) // 2 FROM orders)",
)
def lookup_by_id(spark, sf_dir):
    wanted = S.table(spark, sf_dir, "orders").agg(F.floor(F.max("o_orderkey") / 2)).scalar()
    return R.lookup_by_id(repos(spark, sf_dir), wanted).select(REPO_COLUMNS)


@check("lookup_by_name", "SELECT id, login FROM contributors WHERE login = 'Customer#000000042'")
def lookup_by_name(spark, sf_dir):
    return R.lookup_by_name(S.contributors(spark, sf_dir), "Customer#000000042").select("id", "login")


@check(
    "lookup_owner_name",
    f"""SELECT {REPO} FROM repositories WHERE full_name =
        (SELECT c_name || '/repo-' || o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
         WHERE o_orderkey = 77)""",
)
def lookup_owner_name(spark, sf_dir):
    owner = repos(spark, sf_dir).where(F.col("id") == 77).select(
        F.split_part("full_name", F.lit("/"), F.lit(1))
    ).first()[0]
    return R.lookup_owner_name(repos(spark, sf_dir), owner, "repo-77").select(REPO_COLUMNS)


@check(
    "quality_repos_filter",
    f"""WITH c AS (SELECT repo_id, count(DISTINCT id) AS commits_last_year FROM recent
                   WHERE type = 'PushEvent' AND created_at >= TIMESTAMP '2023-01-31' GROUP BY 1),
             p AS (SELECT repository_id, count(DISTINCT contributor_id) AS contributors_count
                   FROM contributor_repository GROUP BY 1)
        SELECT {REPO}, commits_last_year, contributors_count
        FROM repositories JOIN c ON c.repo_id = id JOIN p ON p.repository_id = id
        WHERE stargazers_count >= 50 AND forks_count >= 10 AND commits_last_year >= 2
          AND contributors_count >= 3""",
)
def quality_repos_filter(spark, sf_dir):
    found = R.quality_repos_filter(
        repos(spark, sf_dir),
        S.events(spark, sf_dir),
        S.contributor_repository(spark, sf_dir),
        AS_OF,
        min_commits_last_year=2,
    )
    return found.select(*REPO_COLUMNS, "commits_last_year", "contributors_count")


@check(
    "search_repos",
    f"""SELECT {REPO} FROM repositories
        WHERE stargazers_count >= 1000 AND forks_count >= 5 AND lower(language) = 'python'
          AND created_at >= TIMESTAMP '1996-01-01' AND created_at < TIMESTAMP '1999-01-02'
        ORDER BY forks_count ASC, id LIMIT 20 OFFSET 20""",
)
def search_repos(spark, sf_dir):
    found = R.search_repos(
        repos(spark, sf_dir),
        min_stars=1000,
        min_forks=5,
        created_after="1996-01-01",
        created_before="1999-01-01",
        language="python",
        sort="forks",
        order="asc",
        per_page=20,
        page=2,
    )
    return found.select(REPO_COLUMNS)


@check(
    "search_repos_since",
    f"""SELECT {REPO} FROM repositories
        WHERE stargazers_count >= 2000 AND lower(language) = 'go' AND created_at >= TIMESTAMP '1997-01-01'""",
)
def search_repos_since(spark, sf_dir):
    return R.search_repos_since(repos(spark, sf_dir), 2000, "1997-01-01", "Go").select(REPO_COLUMNS)


@check(
    "needs_geocoding",
    """SELECT id, login, location FROM contributors
       WHERE location IS NOT NULL AND country_code IS NULL""",
)
def needs_geocoding(spark, sf_dir):
    return G.needs_geocoding(S.with_countries(S.contributors(spark, sf_dir))).select("id", "login", "location")


@check(
    "recent_events",
    """SELECT id, type, actor_id, repo_id FROM recent WHERE created_at >= TIMESTAMP '2024-01-24'""",
)
def recent_events(spark, sf_dir):
    return R.recent_events(S.events(spark, sf_dir), AS_OF, 7).select("id", "type", "actor_id", "repo_id")


@check(
    "non_empty",
    "SELECT id, language FROM repositories WHERE language IS NOT NULL AND language <> ''",
)
def non_empty(spark, sf_dir):
    return R.non_empty(repos(spark, sf_dir), "language").select("id", "language")


@check(
    "month_window",
    f"""SELECT {REPO} FROM repositories
        WHERE created_at >= TIMESTAMP '1997-12-01' AND created_at < TIMESTAMP '1998-01-01'""",
)
def month_window(spark, sf_dir):
    return R.created_within(repos(spark, sf_dir), D.month_of("1997-12")).select(REPO_COLUMNS)


@check(
    "select_repos",
    f"""SELECT {REPO} FROM repositories
        WHERE (id IN (3, 5, 8, 13, 21, 34, 55, 89) OR full_name LIKE '%/repo-1%')
          AND stargazers_count >= 500
          AND id IN (SELECT repo_id FROM recent WHERE type IN ('PushEvent', 'PullRequestEvent'))
        ORDER BY stargazers_count DESC, id LIMIT 10""",
)
def select_repos(spark, sf_dir):
    all_repos = repos(spark, sf_dir)
    found = R.select_repos(
        all_repos,
        S.events(spark, sf_dir),
        repo_ids=[3, 5, 8, 13, 21, 34, 55, 89],
        repo_names=all_repos.where(F.col("name").startswith("repo-1")).select("full_name"),
        event_types=["PushEvent", "PullRequestEvent"],
        min_stars=500,
        limit=10,
    )
    return found.select(REPO_COLUMNS)


@check(
    "preset_range",
    """SELECT id, type FROM recent
       WHERE created_at BETWEEN TIMESTAMP '2024-01-24' AND TIMESTAMP '2024-01-31'""",
)
def preset_range(spark, sf_dir):
    since, until = D.preset_range("week", AS_OF)
    return E.in_days(S.events(spark, sf_dir), E.moment(since), E.moment(until)).select("id", "type")


@check("repo_names", "SELECT full_name FROM repositories")
def repo_names(spark, sf_dir):
    from ..operators.normalize import repo_names as names

    return names(repos(spark, sf_dir))


# ---- joins --------------------------------------------------------------------------------------------
@check(
    "repo_org_join",
    f"""SELECT r.id, full_name, stargazers_count, forks_count, o.login AS organization
        FROM repositories r JOIN organizations o ON o.id = r.organization_id""",
)
def repo_org_join(spark, sf_dir):
    joined = R.repos_with_org(repos(spark, sf_dir), S.organizations(spark, sf_dir))
    return joined.select(*REPO_COLUMNS, "organization")


@check(
    "left_outer_aggregate",
    """SELECT o.id, o.login, count(r.id) AS repository_count
       FROM organizations o LEFT JOIN repositories r ON r.organization_id = o.id GROUP BY 1, 2""",
)
def left_outer_aggregate(spark, sf_dir):
    return R.org_repo_counts(S.organizations(spark, sf_dir), repos(spark, sf_dir))


@check("new_repos_only", f"SELECT {REPO} FROM repositories WHERE NOT fork")
def new_repos_only(spark, sf_dir):
    stored = repos(spark, sf_dir).where("fork")
    return R.new_rows_only(repos(spark, sf_dir), stored).select(REPO_COLUMNS)


@check(
    "repos_of_org",
    f"""SELECT {REPO} FROM repositories
        WHERE organization_id IN (SELECT id FROM organizations WHERE login = 'Supplier#000000003')""",
)
def repos_of_org(spark, sf_dir):
    found = R.repos_of_org(repos(spark, sf_dir), S.organizations(spark, sf_dir), "Supplier#000000003")
    return found.select(REPO_COLUMNS)


GROWTH = """
a AS (SELECT organization_id, CAST(e.created_at AS DATE) AS date, count(DISTINCT actor_id) AS new_members
      FROM recent e JOIN repositories r ON r.id = repo_id
      WHERE organization_id IS NOT NULL AND e.created_at >= TIMESTAMP '{since}' GROUP BY 1, 2),
b AS (SELECT organization_id, CAST(created_at AS DATE) AS date, count(*) AS new_repositories
      FROM repositories WHERE organization_id IS NOT NULL AND created_at >= TIMESTAMP '{since}'
      GROUP BY 1, 2),
g AS (SELECT coalesce(a.organization_id, b.organization_id) AS organization_id,
             coalesce(a.date, b.date) AS date, coalesce(new_members, 0) AS new_members,
             coalesce(new_repositories, 0) AS new_repositories
      FROM a FULL JOIN b ON a.organization_id = b.organization_id AND a.date = b.date)"""
LONG = GROWTH.format(since="2000-09-20")  # about 8530 days before AS_OF: covers both tables
LONG_DAYS = (AS_OF - datetime(2000, 9, 20)).days


@check(
    "growth_outer_merge",
    """WITH a AS (SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS date, count(*) AS pushes
                  FROM recent WHERE type = 'PushEvent' GROUP BY 1),
            b AS (SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS date, count(*) AS repositories
                  FROM repositories GROUP BY 1)
       SELECT coalesce(a.date, b.date) AS date, coalesce(pushes, 0) AS pushes,
              coalesce(repositories, 0) AS repositories
       FROM a FULL JOIN b ON a.date = b.date""",
)
def growth_outer_merge(spark, sf_dir):
    day = F.to_date("created_at").cast("string").alias("date")
    pushes = S.events(spark, sf_dir).where(F.col("type") == "PushEvent")
    left = pushes.groupBy(day).agg(F.count(F.lit(1)).alias("pushes"))
    right = repos(spark, sf_dir).groupBy(day).agg(F.count(F.lit(1)).alias("repositories"))
    return R.outer_merge(left, right, ["date"])


@check(
    "m2m_navigation",
    """SELECT 'repository' AS via, r.full_name AS target, c.login AS contributor
       FROM contributor_repository l JOIN repositories r ON r.id = l.repository_id
       JOIN contributors c ON c.id = l.contributor_id
       UNION ALL
       SELECT 'organization', o.login, c.login
       FROM contributor_organization m JOIN organizations o ON o.id = m.organization_id
       JOIN contributors c ON c.id = m.contributor_id""",
)
def m2m_navigation(spark, sf_dir):
    accounts, orgs_ = S.contributors(spark, sf_dir), S.organizations(spark, sf_dir)
    via_repos = R.repository_contributors(
        repos(spark, sf_dir), accounts, S.contributor_repository(spark, sf_dir)
    )
    via_orgs = R.contributor_organizations(accounts, orgs_, S.contributor_organization(spark, sf_dir))
    return via_repos.select(F.lit("repository").alias("via"), F.col("repository").alias("target"), "contributor").unionByName(
        via_orgs.select(F.lit("organization").alias("via"), F.col("organization").alias("target"), "contributor")
    )


# ---- distributions, coverage, profile ---------------------------------------------------------------
@check(
    "entity_counts",
    """SELECT 'repositories' AS entity, count(*) AS row_count FROM orders
       UNION ALL SELECT 'contributors', count(*) FROM customer
       UNION ALL SELECT 'organizations', count(*) FROM supplier""",
)
def entity_counts(spark, sf_dir):
    return R.entity_counts(
        repositories=repos(spark, sf_dir),
        contributors=S.contributors(spark, sf_dir),
        organizations=S.organizations(spark, sf_dir),
    )


@check(
    "language_statistics",
    """SELECT language, count(*) AS count FROM repositories
       WHERE language IS NOT NULL AND language <> '' GROUP BY 1""",
)
def language_statistics(spark, sf_dir):
    return R.language_statistics(repos(spark, sf_dir))


@check(
    "language_distribution",
    "SELECT language, count(*) AS count FROM repositories WHERE language IS NOT NULL GROUP BY 1",
)
def language_distribution(spark, sf_dir):
    return R.language_distribution(repos(spark, sf_dir))


@check(
    "top_languages",
    """SELECT language, count(*) AS count FROM repositories WHERE language IS NOT NULL
       GROUP BY 1 ORDER BY count DESC, language LIMIT 2""",
)
def top_languages(spark, sf_dir):
    return R.top_languages(repos(spark, sf_dir), 2)


@check(
    "repo_date_range",
    """SELECT strftime(min(created_at), '%Y-%m-%d') AS earliest,
              strftime(max(created_at), '%Y-%m-%d') AS latest FROM repositories""",
)
def repo_date_range(spark, sf_dir):
    return R.repo_date_range(repos(spark, sf_dir))


COVERAGE = """
SELECT count(*) AS total,
       count(*) FILTER (location IS NOT NULL AND location <> '') AS with_location,
       count(*) FILTER (country_code IS NOT NULL AND country_code <> '') AS with_country_code,
       count(*) FILTER (location IS NOT NULL AND location <> '') / count(*) * 100 AS location_percentage,
       count(*) FILTER (country_code IS NOT NULL) / count(*) * 100 AS country_code_percentage,
       count(*) FILTER (country_code IS NOT NULL)
         / count(*) FILTER (location IS NOT NULL AND location <> '') * 100
         AS country_code_from_location_percentage
FROM {table}"""


@check("contributor_location_coverage", COVERAGE.format(table="contributors"))
def contributor_location_coverage(spark, sf_dir):
    return R.location_coverage(S.with_countries(S.contributors(spark, sf_dir)))


@check("organization_location_coverage", COVERAGE.format(table="organizations"))
def organization_location_coverage(spark, sf_dir):
    return R.location_coverage(S.with_countries(S.organizations(spark, sf_dir)))


def _coverage_rows(section, table):
    counts = "".join(
        f" UNION ALL SELECT '{section}', '{name}', CAST({name} AS VARCHAR) FROM {section}_c"
        for name in ("total", "with_location", "with_country_code")
    )
    shares = "".join(
        f" UNION ALL SELECT '{section}', '{name}', CAST(round({name}, 1) AS VARCHAR) FROM {section}_c"
        for name in (
            "location_percentage",
            "country_code_percentage",
            "country_code_from_location_percentage",
        )
    )
    return counts + shares


@check(
    "database_stats",
    f"""WITH contributors_c AS ({COVERAGE.format(table="contributors")}),
             organizations_c AS ({COVERAGE.format(table="organizations")}),
             languages AS (SELECT language, count(*) AS n FROM repositories
                           WHERE language IS NOT NULL AND language <> '' GROUP BY 1
                           ORDER BY n DESC, language LIMIT 10)
        SELECT 'counts' AS section, 'repositories' AS name, CAST(count(*) AS VARCHAR) AS value FROM orders
        UNION ALL SELECT 'counts', 'contributors', CAST(count(*) AS VARCHAR) FROM customer
        UNION ALL SELECT 'counts', 'organizations', CAST(count(*) AS VARCHAR) FROM supplier
        UNION ALL SELECT 'languages', language, CAST(n AS VARCHAR) FROM languages
        UNION ALL SELECT 'date_range', 'earliest', strftime(min(created_at), '%Y-%m-%d') FROM repositories
        UNION ALL SELECT 'date_range', 'latest', strftime(max(created_at), '%Y-%m-%d') FROM repositories
        {_coverage_rows("contributors", "contributors")}
        {_coverage_rows("organizations", "organizations")}""",
)
def database_stats(spark, sf_dir):
    return R.database_stats(
        repos(spark, sf_dir),
        S.with_countries(S.contributors(spark, sf_dir)),
        S.with_countries(S.organizations(spark, sf_dir)),
    )


@check(
    "stars_histogram",
    """WITH e AS (SELECT CAST(min(stargazers_count) AS DOUBLE) AS a, CAST(max(stargazers_count) AS DOUBLE) AS b
                  FROM repositories),
            h AS (SELECT least(CAST(floor((stargazers_count - a) * 50 / (b - a)) AS BIGINT), 49) AS bin,
                         count(*) AS n FROM repositories, e GROUP BY 1)
       SELECT g.bin, a + g.bin * (b - a) / 50 AS low, a + (g.bin + 1) * (b - a) / 50 AS high,
              coalesce(n, 0) AS repositories
       FROM e, (SELECT CAST(range AS BIGINT) AS bin FROM range(50)) g LEFT JOIN h ON h.bin = g.bin""",
)
def stars_histogram(spark, sf_dir):
    return R.stars_histogram(repos(spark, sf_dir))


@check(
    "table_profile",
    """WITH p(name, n, width) AS (
         SELECT 'orders', (SELECT count(*) FROM orders), 4 + 4 + 100 + 0 + 8 + 100 UNION ALL
         SELECT 'customer', (SELECT count(*) FROM customer), 4 + 100 + 4 + 0 + 100 UNION ALL
         SELECT 'events', (SELECT count(*) FROM events), 4 + 8 + 4 + 100 + 0 + 100)
       SELECT name AS "table", n AS rows, n * width / 1048576 AS estimated_mb FROM p
       UNION ALL
       SELECT 'total', CAST(sum(n) AS BIGINT), CAST(sum(n * width) AS BIGINT) / 1048576 FROM p""",
)
def table_profile(spark, sf_dir):
    names = ("orders", "customer", "events")
    return R.table_profile(**{name: S.table(spark, sf_dir, name) for name in names})


# ---- top-k --------------------------------------------------------------------------------------------
@check(
    "top_repositories",
    f"SELECT {REPO} FROM repositories ORDER BY stargazers_count DESC, id LIMIT 10",
)
def top_repositories(spark, sf_dir):
    return R.top_repositories(repos(spark, sf_dir)).select(REPO_COLUMNS)


@check(
    "repos_by_language",
    f"""SELECT {REPO} FROM repositories WHERE language = 'Python'
        ORDER BY stargazers_count DESC, id LIMIT 10""",
)
def repos_by_language(spark, sf_dir):
    return R.repos_by_language(repos(spark, sf_dir), "Python").select(REPO_COLUMNS)


TOP_ORGS = """SELECT o.id, o.login, o.location, count(r.id) AS repo_count
              FROM organizations o JOIN repositories r ON r.organization_id = o.id
              GROUP BY 1, 2, 3 ORDER BY repo_count DESC, o.id LIMIT 5"""


@check("top_organizations", TOP_ORGS)
def top_organizations(spark, sf_dir):
    return R.top_organizations(S.organizations(spark, sf_dir), repos(spark, sf_dir), 5).select(
        "id", "login", "location", "repo_count"
    )


# ---- places --------------------------------------------------------------------------------------------
PLACE = "location, location_lat, location_lon"


@check(
    "contributor_locations",
    f"""SELECT {PLACE}, count(*) AS contributor_count
        FROM recent e JOIN contributors c ON c.id = actor_id
        WHERE repo_id = 7 AND location IS NOT NULL GROUP BY {PLACE}""",
)
def contributor_locations(spark, sf_dir):
    return R.contributor_locations(S.events(spark, sf_dir), people(spark, sf_dir), 7)


@check(
    "organization_locations",
    f"""SELECT {PLACE}, count(r.id) AS repository_count,
               CAST(sum(stargazers_count) AS VARCHAR) AS total_stars
        FROM organizations o LEFT JOIN repositories r ON r.organization_id = o.id
        WHERE location IS NOT NULL GROUP BY {PLACE}""",
)
def organization_locations(spark, sf_dir):
    rows = R.organization_locations(orgs(spark, sf_dir), repos(spark, sf_dir))
    return rows.withColumn("total_stars", text("total_stars"))


@check(
    "active_regions",
    f"""SELECT {PLACE}, count(*) AS event_count
        FROM recent e JOIN contributors c ON c.id = actor_id
        WHERE location IS NOT NULL AND type = 'PushEvent' AND created_at >= TIMESTAMP '2024-01-17'
        GROUP BY {PLACE}""",
)
def active_regions(spark, sf_dir):
    return R.active_regions(S.events(spark, sf_dir), people(spark, sf_dir), AS_OF, "PushEvent", 14)


# ---- organizations over time -----------------------------------------------------------------------------
@check(
    "org_growth",
    f"""WITH {LONG} SELECT organization_id, CAST(date AS VARCHAR) AS date, new_members, new_repositories
        FROM g WHERE organization_id = 3""",
)
def org_growth(spark, sf_dir):
    growth = R.org_growth(S.events(spark, sf_dir), repos(spark, sf_dir), AS_OF, LONG_DAYS, 3)
    return growth.withColumn("date", text("date"))


@check(
    "org_growth_cumulative",
    f"""WITH {LONG} SELECT organization_id, CAST(date AS VARCHAR) AS date,
               CAST(sum(new_members) OVER w AS BIGINT) AS total_members,
               CAST(sum(new_repositories) OVER w AS BIGINT) AS total_repositories
        FROM g WINDOW w AS (PARTITION BY organization_id ORDER BY date
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def org_growth_cumulative(spark, sf_dir):
    growth = R.org_growth(S.events(spark, sf_dir), repos(spark, sf_dir), AS_OF, LONG_DAYS)
    return R.cumulative_growth(growth).withColumn("date", text("date"))


@check(
    "org_top_contributors",
    """SELECT c.login, c.location, count(*) AS contribution_count
       FROM recent e JOIN repositories r ON r.id = repo_id JOIN contributors c ON c.id = actor_id
       WHERE organization_id = 3 AND type IN ('PushEvent', 'PullRequestEvent')
       GROUP BY 1, 2 ORDER BY contribution_count DESC, c.login LIMIT 10""",
)
def org_top_contributors(spark, sf_dir):
    return R.org_top_contributors(
        S.events(spark, sf_dir), repos(spark, sf_dir), S.contributors(spark, sf_dir), 3
    )


@check(
    "repo_activity",
    """SELECT name, language, stargazers_count, forks_count, count(e.id) AS event_count
       FROM repositories r LEFT JOIN recent e ON e.repo_id = r.id
       WHERE organization_id = 3 GROUP BY 1, 2, 3, 4""",
)
def repo_activity(spark, sf_dir):
    return R.repo_activity(S.events(spark, sf_dir), repos(spark, sf_dir), 3)


# ---- runs ---------------------------------------------------------------------------------------------------
@check(
    "collection_by_year",
    """WITH p AS (SELECT strftime(created_at, '%Y') AS year FROM repositories)
       SELECT year, count(*) AS repositories FROM p GROUP BY 1
       UNION ALL SELECT 'total', count(*) FROM p""",
)
def collection_by_year(spark, sf_dir):
    progress = (
        repos(spark, sf_dir)
        .select(D.month_third(F.to_date("created_at")).getField("period").alias("period"))
        .groupBy("period")
        .agg(F.count(F.lit(1)).alias("num_repositories"))
    )
    return R.collection_by_year(progress)


@check(
    "run_success_summary",
    """SELECT count(*) FILTER (type <> 'BogusEvent') AS successful, count(*) AS attempts FROM recent""",
)
def run_success_summary(spark, sf_dir):
    attempts = S.events(spark, sf_dir).select(
        F.col("repo_id").alias("name"), (F.col("type") != "BogusEvent").alias("success")
    )
    return R.run_success_summary(attempts)


@check(
    "repo_contributor_count",
    """SELECT repository_id, count(DISTINCT contributor_id) AS contributors_count
       FROM contributor_repository GROUP BY 1""",
)
def repo_contributor_count(spark, sf_dir):
    return R.repo_contributor_count(S.contributor_repository(spark, sf_dir))


@check(
    "commits_last_year",
    """SELECT repo_id, count(DISTINCT id) AS commits_last_year FROM recent
       WHERE type = 'PushEvent' AND created_at >= TIMESTAMP '2023-01-31' GROUP BY 1""",
)
def commits_last_year(spark, sf_dir):
    return R.commits_last_year(S.events(spark, sf_dir), AS_OF)


# ---- exports ---------------------------------------------------------------------------------------------
@check(
    "export_table_csv",
    """SELECT id, full_name, nullif(language, '') AS language, stargazers_count, CAST(CAST(created_at AS DATE) AS VARCHAR) AS created_at
       FROM repositories""",
)
def export_table_csv(spark, sf_dir):
    table = repos(spark, sf_dir).select("id", "full_name", "language", "stargazers_count", "created_at")
    path = K.export_table_csv(table, fresh_path(spark, "export"), "repositories")
    back = spark.read.csv(
        path,
        header=True,
        schema="id BIGINT, full_name STRING, language STRING, stargazers_count BIGINT, created_at STRING",
    )
    return back.withColumn("created_at", F.substring("created_at", 1, 10))


@check(
    "export_all_tables",
    """SELECT 'fm_contributors' AS "table", count(*) AS row_count FROM customer
       UNION ALL SELECT 'fm_organizations', count(*) FROM supplier""",
)
def export_all_tables(spark, sf_dir):
    S.contributors(spark, sf_dir).createOrReplaceTempView("fm_contributors")
    S.organizations(spark, sf_dir).createOrReplaceTempView("fm_organizations")
    report = K.export_all_tables(
        spark, fresh_path(spark, "export"), ["fm_contributors", "fm_organizations"]
    )
    return report.select("table", "row_count")


@check(
    "exported_files",
    """SELECT 'fm_contributors' AS "table", id, login, nullif(location, '') AS location FROM contributors
       UNION ALL SELECT 'fm_organizations', id, login, nullif(location, '') FROM organizations""",
)
def exported_files(spark, sf_dir):
    """The rows of the files that :func:`export_all_tables` wrote."""
    S.contributors(spark, sf_dir).createOrReplaceTempView("fm_contributors")
    S.organizations(spark, sf_dir).createOrReplaceTempView("fm_organizations")
    names = ["fm_contributors", "fm_organizations"]
    files = K.export_all_tables(spark, fresh_path(spark, "export"), names).collect()
    parts = []
    for file in files:
        columns = spark.table(file["table"]).schema
        rows = spark.read.csv(file["path"], header=True, schema=columns)
        parts.append(rows.select(F.lit(file["table"]).alias("table"), "id", "login", "location"))
    return parts[0].unionByName(parts[1])


@check("export_query_csv", f"SELECT id, login, nullif(location, '') AS location, repo_count FROM ({TOP_ORGS})")
def export_query_csv(spark, sf_dir):
    path = K.export_query_csv(top_organizations(spark, sf_dir), fresh_path(spark, "query.csv"))
    schema = "id BIGINT, login STRING, name STRING, location STRING, repo_count BIGINT"
    return spark.read.csv(path, header=True, schema=schema).drop("name")


# ---- metrics ------------------------------------------------------------------------------------------------
@check(
    "metrics_summary",
    """SELECT CAST(epoch(max(hour)) - epoch(min(hour)) AS BIGINT) AS duration_seconds,
              arg_max(n, hour) AS total_events, round(avg(n / 64.0), 6) AS avg_throughput,
              max(n / 64.0) AS max_throughput, round(avg(n / 4.0), 6) AS avg_memory_mb,
              max(n / 4.0) AS max_memory_mb, arg_max(errors, hour) AS total_errors,
              arg_max(api_calls, hour) AS total_api_calls, arg_max(db_operations, hour) AS total_db_ops
       FROM metrics""",
)
def metrics_summary(spark, sf_dir):
    summary = M.metrics_summary(S.pipeline_metrics(spark, sf_dir))
    for name in ("avg_throughput", "avg_memory_mb"):
        summary = summary.withColumn(name, F.round(name, 6))
    return summary


@check(
    "run_ratios",
    """SELECT run, total_events / duration AS events_per_second,
              CASE WHEN repositories > 0 THEN memory / repositories END AS mb_per_repository
       FROM run_summaries""",
)
def run_ratios(spark, sf_dir):
    return M.run_ratios(S.run_summaries(spark, sf_dir)).select(
        "run", "events_per_second", "mb_per_repository"
    )


@check(
    "timing_breakdown",
    """SELECT run, 'api' AS component, api AS duration FROM run_summaries
       UNION ALL SELECT run, 'bigquery', bigquery FROM run_summaries
       UNION ALL SELECT run, 'other', duration - api - bigquery FROM run_summaries""",
)
def timing_breakdown(spark, sf_dir):
    return M.timing_breakdown(S.run_summaries(spark, sf_dir), ["run"])


@check(
    "event_type_counts",
    """SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS run, type AS event_type, count(*) AS count
       FROM recent GROUP BY 1, 2""",
)
def event_type_counts(spark, sf_dir):
    return M.event_type_counts(S.run_summaries(spark, sf_dir), ["run"])


# ---- insights ------------------------------------------------------------------------------------------------
def links(spark, sf_dir):
    return S.contributor_repository(spark, sf_dir)


def placed(spark, sf_dir):
    return S.with_countries(S.contributors(spark, sf_dir))


@check(
    "country_contributions",
    """SELECT country_code, region, count(DISTINCT contributor_id) AS contributors,
              CAST(sum(contributions) AS BIGINT) AS contributions
       FROM contributor_repository JOIN contributors c ON c.id = contributor_id
       WHERE country_code IS NOT NULL GROUP BY 1, 2""",
)
def country_contributions(spark, sf_dir):
    return X.country_contributions(links(spark, sf_dir), placed(spark, sf_dir))


@check(
    "emerging_hubs",
    """WITH p AS (SELECT *, lag(number_contributors) OVER (PARTITION BY country_code ORDER BY year) AS previous
                  FROM country_yearly_stats)
       SELECT country_code, year, number_contributors,
              CAST(number_contributors - previous AS VARCHAR) AS growth,
              (number_contributors - previous) / previous AS growth_rate FROM p""",
)
def emerging_hubs(spark, sf_dir):
    from .archive_checks import country_yearly_stats

    return X.emerging_hubs(country_yearly_stats(spark, sf_dir)).withColumn("growth", text("growth"))


@check(
    "org_geo_spread",
    """SELECT organization_id, count(DISTINCT contributor_id) AS contributors,
              count(DISTINCT country_code) AS countries
       FROM contributor_repository l JOIN repositories r ON r.id = l.repository_id
       JOIN contributors c ON c.id = contributor_id
       WHERE organization_id IS NOT NULL GROUP BY 1""",
)
def org_geo_spread(spark, sf_dir):
    return X.org_geo_spread(repos(spark, sf_dir), links(spark, sf_dir), placed(spark, sf_dir))


@check(
    "cross_border_pairs",
    """WITH p AS (SELECT DISTINCT repository_id, country_code FROM contributor_repository
                  JOIN contributors c ON c.id = contributor_id WHERE country_code IS NOT NULL)
       SELECT a.country_code AS country_a, b.country_code AS country_b, count(*) AS shared_repositories
       FROM p a JOIN p b ON a.repository_id = b.repository_id AND a.country_code < b.country_code
       GROUP BY 1, 2""",
)
def cross_border_pairs(spark, sf_dir):
    return X.cross_border_pairs(links(spark, sf_dir), placed(spark, sf_dir))


@check(
    "repo_diversity",
    """SELECT repository_id, count(DISTINCT country_code) AS countries FROM contributor_repository
       JOIN contributors c ON c.id = contributor_id WHERE country_code IS NOT NULL GROUP BY 1""",
)
def repo_diversity(spark, sf_dir):
    return X.repo_diversity(links(spark, sf_dir), placed(spark, sf_dir))


@check(
    "language_by_region",
    """WITH n AS (SELECT c.region, language, count(*) AS repositories
                  FROM repositories r JOIN contributors c ON c.id = owner_id
                  WHERE language IS NOT NULL AND language <> '' AND c.region IS NOT NULL GROUP BY 1, 2)
       SELECT region, language, repositories,
              repositories / sum(repositories) OVER (PARTITION BY region) AS share FROM n""",
)
def language_by_region(spark, sf_dir):
    return X.language_by_region(repos(spark, sf_dir), placed(spark, sf_dir))


@check(
    "language_trend",
    """SELECT CAST(year(created_at) AS BIGINT) AS year, language, count(*) AS repositories
       FROM repositories WHERE language IS NOT NULL AND language <> '' GROUP BY 1, 2""",
)
def language_trend(spark, sf_dir):
    return X.language_trend(repos(spark, sf_dir))


@check(
    "key_contributors",
    """SELECT contributor_id, login, count(DISTINCT repository_id) AS repositories,
              CAST(sum(contributions) AS BIGINT) AS contributions
       FROM contributor_repository JOIN contributors c ON c.id = contributor_id
       GROUP BY 1, 2 ORDER BY repositories DESC, contributions DESC, contributor_id LIMIT 10""",
)
def key_contributors(spark, sf_dir):
    return X.key_contributors(links(spark, sf_dir), S.contributors(spark, sf_dir))


@check(
    "contribution_span",
    """SELECT contributor_id, repository_id, contributions,
              strftime(first_contribution_at, '%Y-%m-%d %H:%M:%S.%f') AS first_contribution_at,
              strftime(last_contribution_at, '%Y-%m-%d %H:%M:%S.%f') AS last_contribution_at
       FROM contributor_repository""",
)
def contribution_span(spark, sf_dir):
    return X.contribution_span(S.events(spark, sf_dir)).select(
        "contributor_id",
        "repository_id",
        "contributions",
        time_text("first_contribution_at"),
        time_text("last_contribution_at"),
    )


# ---- dates ---------------------------------------------------------------------------------------------------
@check(
    "event_year",
    "SELECT CAST(year(created_at) AS BIGINT) AS year, count(*) AS events FROM archive GROUP BY 1",
)
def event_year(spark, sf_dir):
    rows = S.archive_events(spark, sf_dir)
    return rows.groupBy(D.event_year(F.col("created_at")).alias("year")).agg(F.count(F.lit(1)).alias("events"))


@check(
    "event_day",
    "SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS day, count(*) AS events FROM recent GROUP BY 1",
)
def event_day(spark, sf_dir):
    day = D.event_day(F.col("created_at")).cast("string").alias("day")
    return S.events(spark, sf_dir).groupBy(day).agg(F.count(F.lit(1)).alias("events"))


@check(
    "day_suffix",
    "SELECT strftime(created_at, '%Y%m%d') AS suffix, count(*) AS events FROM recent GROUP BY 1",
)
def day_suffix(spark, sf_dir):
    suffix = D.day_suffix(F.col("created_at")).alias("suffix")
    return S.events(spark, sf_dir).groupBy(suffix).agg(F.count(F.lit(1)).alias("events"))


@check(
    "next_month_first",
    """SELECT CAST(CAST(date_trunc('month', created_at) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS next_month,
              count(*) AS repositories FROM repositories GROUP BY 1""",
)
def next_month_first(spark, sf_dir):
    first = D.next_month_first(F.to_date("created_at")).cast("string").alias("next_month")
    return repos(spark, sf_dir).groupBy(first).agg(F.count(F.lit(1)).alias("repositories"))


@check(
    "parse_iso_ts",
    """SELECT id, CASE WHEN id % 4 <> 0 THEN strftime(created_at, '%Y-%m-%d %H:%M:%S') END AS created_at
       FROM repositories""",
)
def parse_iso_ts(spark, sf_dir):
    written = F.when(F.col("id") % 4 == 0, "last spring").otherwise(
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    parsed = D.parse_timestamp(written, "timestamp_ntz")
    return repos(spark, sf_dir).select("id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("created_at"))
