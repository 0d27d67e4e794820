"""Checked queries: archive scans, archive aggregates, statistics tables, streaming."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import events as E, upsert as U
from ..sinks import tables as K
from ..sources import archive as A, entities as N, sample_tables as S
from ..streaming import ingest as I
from ..workspace import fresh_path
from .registry import check, stored, text, time_text

AS_OF = datetime(2024, 1, 31)
YEARS = (1996, 2000)
STAT_COLUMNS = "number_repos, forks, stars, number_contributors"


# ---- scans and projections ---------------------------------------------------------------------
@check(
    "scan_archive",
    """SELECT CAST(id AS BIGINT) AS id, type, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at
       FROM recent
       WHERE created_at BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00'""",
)
def scan_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archive")
    events = S.events(spark, sf_dir)
    A.write_archive(events, path)
    schema = events.withColumn("day", F.lit("")).schema
    found = A.scan_archive(
        spark, path, "20240105", "20240112", "2024-01-05 06:00:00", "2024-01-12 18:00:00", schema
    )
    return found.select("id", "type", time_text("created_at"))


@check(
    "event_projection",
    """SELECT id, type, actor_login, repo_name, CAST(CAST(created_at AS DATE) AS VARCHAR) AS created_at
       FROM archive""",
)
def event_projection(spark, sf_dir):
    rows = E.event_projection(S.archive_events(spark, sf_dir))
    return rows.withColumn("created_at", F.to_date("created_at").cast("string"))


def _newest_repository(spark, sf_dir):
    """Name of the repository with the highest id, and the time of its last event."""
    newest = S.table(spark, sf_dir, "lineitem").agg(F.max("l_orderkey")).scalar()
    return (
        S.archive_events(spark, sf_dir)
        .where(F.col("repo.id") == newest)
        .agg(F.max_by("repo.name", "created_at"), F.max("created_at"))
        .first()
    )


@check(
    "repo_events",
    """SELECT id, type, actor_login, repo_name, CAST(CAST(created_at AS DATE) AS VARCHAR) AS created_at
       FROM archive, (SELECT repo_name AS wanted, max(created_at) AS latest FROM archive
                      WHERE repo_id = (SELECT max(repo_id) FROM archive) GROUP BY 1)
       WHERE repo_name = wanted AND type IN ('PushEvent', 'WatchEvent', 'ForkEvent')
         AND created_at BETWEEN latest - INTERVAL 30 DAY AND latest""",
)
def repo_events(spark, sf_dir):
    events = S.archive_events(spark, sf_dir)
    name, until = _newest_repository(spark, sf_dir)
    rows = E.repo_events(
        events, name, until, until - timedelta(days=30), E.STATS_TYPES
    )
    return rows.withColumn("created_at", F.to_date("created_at").cast("string"))


@check(
    "repo_metrics",
    """SELECT count(DISTINCT actor_login) FILTER (type = 'WatchEvent') AS stars,
              count(DISTINCT actor_login) FILTER (type = 'PushEvent') AS contributors,
              count(DISTINCT id) FILTER (type = 'PushEvent') AS commits
       FROM archive, (SELECT repo_name AS wanted, max(created_at) AS latest FROM archive
                      WHERE repo_id = (SELECT max(repo_id) FROM archive) GROUP BY 1)
       WHERE repo_name = wanted AND created_at BETWEEN latest - INTERVAL 30 DAY AND latest""",
)
def repo_metrics(spark, sf_dir):
    events = S.archive_events(spark, sf_dir)
    name, until = _newest_repository(spark, sf_dir)
    return E.repo_metrics(events, name, until, until - timedelta(days=30))


# ---- yearly statistics ---------------------------------------------------------------------------
@check(
    "org_yearly_stats",
    f"SELECT year, organization_login, {STAT_COLUMNS} FROM org_stats",
)
def org_yearly_stats(spark, sf_dir):
    return E.org_yearly_stats(S.archive_events(spark, sf_dir), *YEARS, S.archive_tasks(spark, sf_dir))


@check("org_yearly_commits", "SELECT * FROM org_commits")
def org_yearly_commits(spark, sf_dir):
    return E.org_yearly_commits(S.archive_events(spark, sf_dir), *YEARS, S.archive_tasks(spark, sf_dir))


@check("org_yearly_stats_push", "SELECT * FROM org_push_stats")
def org_yearly_stats_push(spark, sf_dir):
    return E.org_yearly_stats_push(S.archive_events(spark, sf_dir), YEARS[0], YEARS[1], AS_OF)


@check("org_yearly_simple", "SELECT year, organization_login, number_repos, stars FROM org_push_stats")
def org_yearly_simple(spark, sf_dir):
    return E.org_yearly_simple(S.archive_events(spark, sf_dir), *YEARS)


@check(
    "org_stats_enrich",
    f"""SELECT s.year, s.organization_login, o.id AS organization_id, o.location, o.country_code,
               o.region, {STAT_COLUMNS}
        FROM org_stats s JOIN organizations o ON o.login = s.organization_login AND country_code IS NOT NULL""",
)
def org_stats_enrich(spark, sf_dir):
    known = S.with_countries(S.organizations(spark, sf_dir)).where("country_code IS NOT NULL")
    return E.enrich_with_organizations(org_yearly_stats(spark, sf_dir), known)


@check(
    "unknown_organizations",
    f"""SELECT year, organization_login, {STAT_COLUMNS} FROM org_stats
        WHERE organization_login NOT IN (SELECT login FROM organizations WHERE country_code IS NOT NULL)""",
)
def unknown_organizations(spark, sf_dir):
    known = S.with_countries(S.organizations(spark, sf_dir)).where("country_code IS NOT NULL")
    return E.unknown_organizations(org_yearly_stats(spark, sf_dir), known)


@check(
    "commit_backfill",
    f"""SELECT s.year, s.organization_login, {STAT_COLUMNS},
               CASE WHEN s.year >= 1998 THEN coalesce(c.number_commits, 0) ELSE 0 END AS number_commits
        FROM org_stats s LEFT JOIN org_commits c
          ON c.year = s.year AND c.organization_login = s.organization_login""",
)
def commit_backfill(spark, sf_dir):
    commits = org_yearly_commits(spark, sf_dir).where(F.col("year") >= 1998)
    return E.backfill_commits(org_yearly_stats(spark, sf_dir), commits)


def organization_statistics(spark, sf_dir):
    orgs = S.with_countries(S.organizations(spark, sf_dir))
    return E.organization_statistics(S.archive_events(spark, sf_dir), orgs, *YEARS, S.archive_tasks(spark, sf_dir))


ORG_YEARLY = """year, organization_id, location, country_code, region, forks, stars, number_repos,
                number_commits, number_contributors"""
COUNTRY_YEARLY = """year, country_code, region, forks, stars, number_repos, number_commits,
                    number_organizations, number_contributors"""


@check("organization_statistics", f"SELECT {ORG_YEARLY} FROM organization_yearly_stats")
def organization_statistics_query(spark, sf_dir):
    return organization_statistics(spark, sf_dir)


@check("country_yearly_stats", f"SELECT {COUNTRY_YEARLY} FROM country_yearly_stats")
def country_yearly_stats(spark, sf_dir):
    return E.country_yearly_stats(organization_statistics(spark, sf_dir), *YEARS)


@check(
    "country_input_stats",
    """SELECT year, country_code, min(region) AS region, CAST(sum(forks) AS BIGINT) AS forks,
              CAST(sum(stars) AS BIGINT) AS stars, CAST(sum(number_repos) AS BIGINT) AS number_repos,
              CAST(sum(number_commits) AS BIGINT) AS number_commits,
              count(DISTINCT o.id) AS number_organizations,
              CAST(sum(contributors) AS BIGINT) AS number_contributors
       FROM org_push_stats JOIN organizations o ON o.login = organization_login
       WHERE country_code IS NOT NULL GROUP BY 1, 2""",
)
def country_input_stats(spark, sf_dir):
    orgs = S.with_countries(S.organizations(spark, sf_dir))
    return E.country_input_stats(S.archive_events(spark, sf_dir), orgs, *YEARS)


@check(
    "daily_event_counts",
    """SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS date, count(*) AS event_count
       FROM archive GROUP BY 1""",
)
def daily_event_counts(spark, sf_dir):
    return E.daily_event_counts(S.archive_events(spark, sf_dir)).select(text("date"), "event_count")


@check(
    "events_time_bucket",
    """SELECT strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:%M:%S') AS bucket_start, type,
              count(*) AS event_count
       FROM recent GROUP BY 1, 2""",
)
def events_time_bucket(spark, sf_dir):
    return E.events_per_bucket(S.events(spark, sf_dir)).select(
        F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss").alias("bucket_start"), "type", "event_count"
    )


# ---- upserts of statistics -------------------------------------------------------------------------
@check(
    "upsert_org_yearly_stats",
    """SELECT year, organization_id,
              CASE WHEN year < 1999 THEN 'stored' ELSE location END AS location, country_code, region,
              CASE WHEN year > 1996 THEN forks ELSE 1 END AS forks,
              CASE WHEN year > 1996 THEN stars ELSE 2 END AS stars,
              CASE WHEN year > 1996 THEN number_repos ELSE 3 END AS number_repos,
              CASE WHEN year > 1996 THEN number_commits ELSE 4 END AS number_commits,
              CASE WHEN year > 1996 THEN number_contributors ELSE 5 END AS number_contributors
       FROM organization_yearly_stats""",
)
def upsert_org_yearly_stats(spark, sf_dir):
    fresh = stored(organization_statistics(spark, sf_dir), "organization_yearly_stats")
    before = fresh.where(F.col("year") < 1999).withColumn("location", F.lit("stored"))
    for value, name in enumerate(E.SUMS[:3] + E.SUMS[3:], start=1):
        before = before.withColumn(name, F.lit(value).cast("bigint"))
    return U.upsert_org_yearly_stats(before, fresh.where(F.col("year") > 1996))


@check(
    "upsert_country_yearly_stats",
    """SELECT year, country_code, CASE WHEN year < 1999 THEN 'stored' ELSE region END AS region,
              CASE WHEN year > 1996 THEN forks ELSE 0 END AS forks,
              CASE WHEN year > 1996 THEN stars ELSE 0 END AS stars,
              CASE WHEN year > 1996 THEN number_repos ELSE 0 END AS number_repos,
              CASE WHEN year > 1996 THEN number_commits ELSE 0 END AS number_commits,
              CASE WHEN year > 1996 THEN number_organizations ELSE 0 END AS number_organizations,
              CASE WHEN year > 1996 THEN number_contributors ELSE 0 END AS number_contributors
       FROM country_yearly_stats""",
)
def upsert_country_yearly_stats(spark, sf_dir):
    fresh = stored(country_yearly_stats(spark, sf_dir), "country_yearly_stats")
    before = fresh.where(F.col("year") < 1999).withColumn("region", F.lit("stored"))
    for name in [*E.SUMS, "number_organizations"]:
        before = before.withColumn(name, F.lit(0).cast("bigint"))
    return U.upsert_country_yearly_stats(before, fresh.where(F.col("year") > 1996))


# ---- exports -----------------------------------------------------------------------------------------
def _csv(spark, path, schema):
    return spark.read.csv(path, header=True, schema=schema)


ORG_CSV = """`Jahr` BIGINT, `Organization` STRING, `Location` STRING, `Country` STRING, `Region` STRING,
`Forks` BIGINT, `Stars` BIGINT, `Number Repos` BIGINT, `Number Commits` BIGINT, `Contributors` BIGINT"""
COUNTRY_CSV = """`Jahr` BIGINT, `Country` STRING, `Region` STRING, `Forks` BIGINT, `Stars` BIGINT,
`Number Repos` BIGINT, `Number Commits` BIGINT, `Organization Count` BIGINT, `Contributor Count` BIGINT"""
ORG_EXPORT_SQL = """SELECT year AS "Jahr", login AS "Organization",
       nullif(location, '') AS "Location", country_code AS "Country", region AS "Region",
       forks AS "Forks", stars AS "Stars", number_repos AS "Number Repos",
       number_commits AS "Number Commits", number_contributors AS "Contributors"
  FROM organization_yearly_stats"""
COUNTRY_EXPORT_SQL = """SELECT year AS "Jahr", country_code AS "Country", region AS "Region",
       forks AS "Forks", stars AS "Stars", number_repos AS "Number Repos",
       number_commits AS "Number Commits", number_organizations AS "Organization Count",
       number_contributors AS "Contributor Count"
  FROM country_yearly_stats"""


@check("export_org_stats", ORG_EXPORT_SQL)
def export_org_stats(spark, sf_dir):
    path = fresh_path(spark, "organization_stats.csv")
    K.export_org_stats(organization_statistics(spark, sf_dir), S.organizations(spark, sf_dir), path)
    return _csv(spark, path, ORG_CSV)


@check("export_country_stats", COUNTRY_EXPORT_SQL)
def export_country_stats(spark, sf_dir):
    path = fresh_path(spark, "country_stats.csv")
    K.export_country_stats(country_yearly_stats(spark, sf_dir), path)
    return _csv(spark, path, COUNTRY_CSV)


@check(
    "export_stats_bundle",
    f"""SELECT 'organization' AS export, count(*) AS rows, CAST(sum("Forks") AS BIGINT) AS forks
        FROM ({ORG_EXPORT_SQL})
        UNION ALL
        SELECT 'country', count(*), CAST(sum("Forks") AS BIGINT) FROM ({COUNTRY_EXPORT_SQL})""",
)
def export_stats_bundle(spark, sf_dir):
    stats = stored(organization_statistics(spark, sf_dir), "organization_yearly_stats")
    paths = K.export_stats_bundle(
        stats,
        S.organizations(spark, sf_dir),
        E.country_yearly_stats(stats, *YEARS),
        fresh_path(spark, "bundle"),
    )
    parts = [
        _csv(spark, path, schema).agg(F.count(F.lit(1)).alias("rows"), F.sum("Forks").alias("forks"))
        .select(F.lit(name).alias("export"), "rows", "forks")
        for name, path, schema in zip(("organization", "country"), paths, (ORG_CSV, COUNTRY_CSV))
    ]
    return parts[0].unionByName(parts[1])


# ---- streaming -----------------------------------------------------------------------------------------
def _event_stream(spark, sf_dir):
    schema = S.table(spark, sf_dir, "events").schema
    return I.file_stream(spark, f"{sf_dir}/events*.parquet", schema)


RECENT_SQL = """SELECT id, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at, actor_id, repo_id,
                       type FROM recent"""


def _event_rows(rows):
    return rows.select("id", time_text("created_at"), "actor_id", "repo_id", "type")


@check("stream_event_ingest", RECENT_SQL)
def stream_event_ingest(spark, sf_dir):
    out, checkpoint = fresh_path(spark, "ingest"), fresh_path(spark, "ingest-state")
    rows = S.events_from(_event_stream(spark, sf_dir))
    for _ in range(2):  # the second run finds nothing new
        I.stream_event_ingest(rows, out, checkpoint).awaitTermination()
    return _event_rows(spark.read.parquet(out))


@check("stream_dedupe", RECENT_SQL)
def stream_dedupe(spark, sf_dir):
    out, checkpoint = fresh_path(spark, "dedupe"), fresh_path(spark, "dedupe-state")
    rows = S.events_from(_event_stream(spark, sf_dir))
    twice = rows.unionByName(rows)
    I.stream_dedupe(twice, out, checkpoint, delay="40 days").awaitTermination()
    return _event_rows(spark.read.parquet(out))


@check("stream_org_upsert", f"SELECT year, organization_login, {STAT_COLUMNS} FROM org_stats")
def stream_org_upsert(spark, sf_dir):
    """Two deliveries whose organizations and repositories overlap; the stream is started anew for the second."""
    lines = S.table(spark, sf_dir, "lineitem")
    source, archive, stats, state = (
        fresh_path(spark, f"stream-{name}") for name in ("source", "archive", "stats", "state")
    )
    delivery = F.pmod(F.hash("l_orderkey", "l_linenumber"), F.lit(2))
    for number in range(2):
        lines.where(delivery == number).write.mode("append").parquet(source)
        rows = S.archive_events(spark, sf_dir, I.file_stream(spark, source, lines.schema))
        I.stream_org_upsert(rows, archive, stats, state, *YEARS).awaitTermination()
    return I.current_stats(spark, stats)


# ---- stored tables -----------------------------------------------------------------------------------
@check(
    "scan_entities",
    """SELECT id, full_name, owner_id, stargazers_count, forks_count, fork,
              CAST(CAST(created_at AS DATE) AS VARCHAR) AS created_at FROM repositories""",
)
def scan_entities(spark, sf_dir):
    path = K.store_entity(S.repositories(spark, sf_dir), fresh_path(spark, "repositories"), "repositories")
    return N.scan_entities(spark, path, "repositories").select(
        "id",
        "full_name",
        "owner_id",
        F.col("stargazers_count").cast("bigint").alias("stargazers_count"),
        F.col("forks_count").cast("bigint").alias("forks_count"),
        "fork",
        F.to_date("created_at").cast("string").alias("created_at"),
    )


@check(
    "scan_location_dim",
    """SELECT c_name AS location,
              CASE WHEN c_custkey % 3 < 2 THEN upper(substr(c_mktsegment, 1, 2)) END AS country_code,
              CASE WHEN c_custkey % 3 < 2 THEN c_mktsegment END AS region
       FROM customer""",
)
def scan_location_dim(spark, sf_dir):
    code, region = F.upper(F.substring("c_mktsegment", 1, 2)), F.col("c_mktsegment")
    entry = (
        F.when(F.col("c_custkey") % 3 == 0, F.to_json(F.array(code, region)))
        .when(
            F.col("c_custkey") % 3 == 1,
            F.to_json(F.struct(code.alias("country_code"), region.alias("region"))),
        )
        .otherwise("null")
    )
    rows = S.table(spark, sf_dir, "customer").select(
        F.concat(F.lit('{"'), F.col("c_name"), F.lit('": '), entry, F.lit("}")).alias("value")
    )
    return N.location_dim(rows)


@check(
    "scan_metrics_csv",
    """SELECT strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, 'pipeline' AS component,
              'repository ' || repo_id || chr(10) || 'said "no", twice' AS error
       FROM recent WHERE type = 'BogusEvent'""",
)
def scan_metrics_csv(spark, sf_dir):
    path = fresh_path(spark, "errors.csv")
    errors = S.events(spark, sf_dir).where(F.col("type") == "BogusEvent")
    errors.select(
        time_text("created_at", "timestamp"),
        F.lit("pipeline").alias("component"),
        F.concat(F.lit("repository "), "repo_id", F.lit('\nsaid "no", twice')).alias("error"),
    ).write.csv(path, header=True, quote='"', escape='"')
    return N.scan_metrics_csv(spark, path, "errors").withColumn("timestamp", time_text("timestamp"))
