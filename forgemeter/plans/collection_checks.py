"""Checked queries: JSON records, entity upserts, collection strategies."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ..functions import dates as D, fixed_values as V
from ..operators import collect as C, normalize as J, upsert as U
from ..sources import sample_tables as S
from .registry import check, stored, text

AS_OF = date(2001, 6, 30)
JOINED = datetime(2024, 1, 31)
REPO = "id, full_name, stargazers_count"
BEST = "stargazers_count DESC, id"


def repos(spark, sf_dir):
    return S.repositories(spark, sf_dir)


# ---- JSON records ------------------------------------------------------------------------------------
RECORDS = """
SELECT id, name, full_name,
       CASE WHEN id % 4 = 0 THEN '' ELSE coalesce(language, '') END AS language,
       CASE WHEN id % 5 = 0 THEN 0 ELSE stargazers_count END AS stargazers_count,
       CASE WHEN id % 7 <> 0 THEN 'main' END AS default_branch, fork AS is_fork,
       CASE WHEN id % 3 = 1 THEN 'mit' END AS license,
       CASE WHEN id % 2 = 0 THEN 'data spark' ELSE '' END AS topics, 'public' AS visibility,
       CASE WHEN id % 6 <> 0 THEN owner_id END AS owner_id,
       CASE WHEN id % 6 = 0 THEN '' ELSE split_part(full_name, '/', 1) END AS owner_login,
       CASE WHEN id % 6 <> 0 AND id % 5 = 1 THEN 'Organization' ELSE 'User' END AS owner_type
FROM repositories"""


@check(
    "normalize_repository",
    f"SELECT * REPLACE (CAST(owner_id AS VARCHAR) AS owner_id) FROM ({RECORDS})",
)
def normalize_repository(spark, sf_dir):
    rows = J.normalize_repository(S.repository_records(spark, sf_dir))
    return rows.select(
        "id", "name", "full_name", "language", "stargazers_count", "default_branch", "is_fork", "license",
        F.concat_ws(" ", "topics").alias("topics"), "visibility", text("owner_id"), "owner_login", "owner_type",
    )


ACCOUNT = """
SELECT id, login, '' AS name, CASE WHEN id % 2 = 0 THEN '' ELSE location END AS location, {fields},
       CASE WHEN id % 4 = 0 THEN 0 ELSE id % 50 END AS public_repos
FROM {table}"""
BOT = "CASE WHEN id % 3 = 0 THEN 'User' ELSE 'Bot' END AS type"


@check("normalize_user", ACCOUNT.format(table="contributors", fields=BOT))
def normalize_user(spark, sf_dir):
    rows = J.normalize_user(S.account_records(S.contributors(spark, sf_dir)))
    return rows.select("id", "login", "name", "location", "type", "public_repos")


@check(
    "normalize_organization",
    ACCOUNT.format(table="organizations", fields="id % 5 = 0 AS is_verified"),
)
def normalize_organization(spark, sf_dir):
    rows = J.normalize_organization(S.account_records(S.organizations(spark, sf_dir)))
    return rows.select("id", "login", "name", "location", "is_verified", "public_repos")


@check(
    "normalize_contributor",
    f"""SELECT id, login, {BOT}, id % 5 = 0 AS site_admin,
               CASE WHEN id % 4 = 0 THEN 0 ELSE id % 50 END AS contributions
        FROM contributors""",
)
def normalize_contributor(spark, sf_dir):
    rows = J.normalize_contributor(S.account_records(S.contributors(spark, sf_dir)))
    return rows.select("id", "login", "type", "site_admin", "contributions")


@check(
    "owner_split",
    f"""WITH r AS ({RECORDS}), o AS (
          SELECT owner_id AS id, first(owner_login ORDER BY owner_login IS NULL, owner_type IS NULL, id) AS login,
                 first(owner_type ORDER BY owner_login IS NULL, owner_type IS NULL, id) AS type
          FROM r WHERE owner_id IS NOT NULL GROUP BY 1)
        SELECT 'repository' AS kind, id, full_name AS label,
               CASE WHEN owner_type = 'Organization' THEN CAST(owner_id AS VARCHAR) END AS organization FROM r
        UNION ALL SELECT 'contributor', id, login, NULL FROM o
        UNION ALL SELECT 'organization', id, login, NULL FROM o WHERE type = 'Organization'""",
)
def owner_split(spark, sf_dir):
    rows = stored(J.normalize_repository(S.repository_records(spark, sf_dir)), "records")
    found, contributors, organizations = J.owner_split(rows)
    none = F.lit(None).cast("string").alias("organization")
    return (
        found.select(
            F.lit("repository").alias("kind"), "id", F.col("full_name").alias("label"),
            text("organization_id", "organization"),
        )
        .unionByName(contributors.select(F.lit("contributor").alias("kind"), "id", F.col("login").alias("label"), none))
        .unionByName(organizations.select(F.lit("organization").alias("kind"), "id", F.col("login").alias("label"), none))
    )


@check(
    "repo_bundle",
    """SELECT 'repository' AS kind, r.id, full_name AS label, max(o.login) AS other, count(l.contributor_id) AS links,
              CAST(coalesce(sum(l.contributions), 0) AS BIGINT) AS contributions
       FROM repositories r LEFT JOIN organizations o ON o.id = r.organization_id
       LEFT JOIN contributor_repository l ON l.repository_id = r.id
       GROUP BY r.id, full_name
       UNION ALL SELECT 'contributor', l.repository_id, c.login, NULL, l.contributor_id, l.contributions
       FROM contributor_repository l JOIN contributors c ON c.id = l.contributor_id""",
)
def repo_bundle(spark, sf_dir):
    bundles, people = J.repo_bundle(
        repos(spark, sf_dir),
        S.organizations(spark, sf_dir),
        S.contributor_repository(spark, sf_dir),
        S.contributors(spark, sf_dir),
    )
    first = bundles.select(
        F.lit("repository").alias("kind"), "id", F.col("full_name").alias("label"),
        F.col("organization.login").alias("other"), F.col("contributors_count").alias("links"), "contributions",
    )
    second = people.select(
        F.lit("contributor").alias("kind"), F.col("repository_id").alias("id"), F.col("login").alias("label"),
        F.lit(None).cast("string").alias("other"), F.col("contributor_id").alias("links"), "contributions",
    )
    return first.unionByName(second)


# ---- upserts -----------------------------------------------------------------------------------------
@check(
    "upsert_repositories",
    """SELECT id, full_name,
              CASE WHEN id % 3 = 0 THEN CASE WHEN id % 2 = 0 THEN NULL ELSE 'Rust' END ELSE language END AS language,
              CASE WHEN id % 3 = 0 THEN 7 ELSE stargazers_count END AS stargazers_count,
              CASE WHEN id % 3 = 0 AND id % 4 <> 0 THEN 0 ELSE forks_count END AS forks_count,
              CASE WHEN id % 3 = 0 THEN CASE WHEN id % 4 = 0
                   THEN strftime(created_at, '%Y-%m-%d %H:%M:%S') ELSE '2020-01-02 03:04:05' END
                   ELSE strftime(created_at, '%Y-%m-%d %H:%M:%S') END AS created_at
       FROM repositories WHERE id % 4 = 0 OR id % 3 = 0""",
)
def upsert_repositories(spark, sf_dir):
    """Every fourth repository is stored; every third gets two records, the later one wins.

    The stars of the first record are overwritten, its language stays where the second names none;
    a time is only readable in records of repositories that are not stored yet.
    """
    columns = ["id", "full_name", "language", "stargazers_count", "forks_count", "owner_id", "created_at"]
    stored = repos(spark, sf_dir).where(F.col("id") % 4 == 0).select(columns)
    touched = repos(spark, sf_dir).where(F.col("id") % 3 == 0)
    language = F.when(F.col("id") % 2 == 0, "null").otherwise('"Rust"')
    when = F.when(F.col("id") % 4 == 0, "soon").otherwise("2020-01-02T03:04:05Z")
    first = F.concat(
        F.lit('{"id": '), "id", F.lit(', "stargazers_count": 5, "full_name": "'), "full_name",
        F.lit('", "language": '), language, F.lit("}"),
    )
    second = F.concat(
        F.lit('{"id": '), "id", F.lit(', "stargazers_count": 7, "created_at": "'), when, F.lit('"}')
    )
    records = touched.select(F.lit(1).alias("seq"), first.alias("json")).unionByName(
        touched.select(F.lit(2).alias("seq"), second.alias("json"))
    )
    updates = U.repository_updates(records, time_type="timestamp_ntz")
    merged = U.upsert_repositories(stored, updates)
    return merged.select(
        "id", "full_name", "language", "stargazers_count", "forks_count",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )


def _insert_check(table):
    return f"""SELECT id, CASE WHEN id % 2 = 0 THEN login ELSE 'new-' || login END AS login FROM {table}"""


def _insert(spark, accounts, insert):
    stored = accounts.where(F.col("id") % 2 == 0).select("id", "login")
    again = accounts.select("id", F.concat(F.lit("new-"), "login").alias("login"), F.lit(1).alias("seq"))
    later = accounts.select("id", F.lit("later").alias("login"), F.lit(2).alias("seq"))
    return insert(stored, again.unionByName(later), "seq").select("id", "login")


@check("insert_contributors", _insert_check("contributors"))
def insert_contributors(spark, sf_dir):
    return _insert(spark, S.contributors(spark, sf_dir), U.insert_contributors)


@check("insert_organizations", _insert_check("organizations"))
def insert_organizations(spark, sf_dir):
    return _insert(spark, S.organizations(spark, sf_dir), U.insert_organizations)


@check(
    "link_contributor_repo",
    """SELECT contributor_id, repository_id,
              CASE WHEN contributor_id % 2 = 0 THEN contributions ELSE 0 END AS contributions
       FROM contributor_repository""",
)
def link_contributor_repo(spark, sf_dir):
    links = S.contributor_repository(spark, sf_dir).select("contributor_id", "repository_id", "contributions")
    stored = links.where(F.col("contributor_id") % 2 == 0)
    return U.link_contributor_repo(stored, links.withColumn("contributions", F.lit(None).cast("bigint")))


@check(
    "link_contributor_org",
    """SELECT contributor_id, organization_id,
              CASE WHEN contributor_id % 3 = 0 THEN '2020-01-01 00:00:00' ELSE '2024-01-31 00:00:00' END AS joined_at
       FROM contributor_organization""",
)
def link_contributor_org(spark, sf_dir):
    links = S.contributor_organization(spark, sf_dir)
    stored = links.where(F.col("contributor_id") % 3 == 0).withColumn(
        "joined_at", F.lit("2020-01-01").cast("timestamp_ntz")
    )
    merged = U.link_contributor_org(stored, links, JOINED)
    return merged.withColumn("joined_at", F.date_format("joined_at", "yyyy-MM-dd HH:mm:ss"))


# ---- limits and dedupe -----------------------------------------------------------------------------------
@check(
    "top_n_per_stratum",
    f"""SELECT {REPO}, language, year, rank FROM (
          SELECT *, CAST(year(created_at) AS BIGINT) AS year,
                 row_number() OVER (PARTITION BY language, year(created_at) ORDER BY {BEST}) AS rank
          FROM repositories) WHERE rank <= 20""",
)
def top_n_per_stratum(spark, sf_dir):
    rows = repos(spark, sf_dir).withColumn("year", D.event_year(F.col("created_at")))
    ranked = C.top_n_per_stratum(rows, ["language", "year"], 20)
    return ranked.select(
        "id", "full_name", "stargazers_count", "language", "year", F.col("rank").cast("bigint").alias("rank")
    )


@check(
    "global_target_cap",
    f"""SELECT {REPO}, CAST(CAST(created_at AS DATE) AS VARCHAR) AS day FROM repositories
        ORDER BY CAST(created_at AS DATE), {BEST} LIMIT 500""",
)
def global_target_cap(spark, sf_dir):
    rows = repos(spark, sf_dir).withColumn("day", F.to_date("created_at"))
    capped = C.cap_total(rows, "day", 500)
    return capped.select("id", "full_name", "stargazers_count", text("day"))


@check(
    "dedupe_ids",
    "SELECT l_orderkey AS id, min(l_linenumber * 1000 + l_suppkey) AS seen FROM lineitem GROUP BY 1",
)
def dedupe_ids(spark, sf_dir):
    rows = S.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), (F.col("l_linenumber") * 1000 + F.col("l_suppkey")).alias("seen")
    )
    return C.dedupe_ids(rows, F.col("seen"))


def _quality_sql(where):
    part = """SELECT {repo}, {n} AS strategy FROM (SELECT * FROM repositories WHERE stargazers_count >= 100
              AND forks_count >= 5 {where} ORDER BY {order} DESC, id LIMIT 30) WHERE NOT fork"""
    return " UNION ALL ".join(
        part.format(repo=REPO, n=n, where=where, order=order)
        for n, order in enumerate(("stargazers_count", "forks_count", "updated_at"))
    )


def _quality(spark, sf_dir, period=None):
    stored = repos(spark, sf_dir).where("fork")
    found = C.quality_repositories(repos(spark, sf_dir), stored, 90, period, min_stars=100, min_forks=5)
    return found.select("id", "full_name", "stargazers_count", F.col("strategy").cast("bigint").alias("strategy"))


@check("quality_repo_union", _quality_sql(""))
def quality_repo_union(spark, sf_dir):
    return _quality(spark, sf_dir)


@check(
    "quality_repositories",
    _quality_sql("AND created_at >= TIMESTAMP '1998-05-01' AND created_at < TIMESTAMP '1998-06-01'"),
)
def quality_repositories(spark, sf_dir):
    return _quality(spark, sf_dir, "1998-05")


# ---- periods --------------------------------------------------------------------------------------------
THIRD = """
CASE WHEN day({d}) <= 10 THEN strftime({d}, '%Y-%m-01-10') WHEN day({d}) <= 20 THEN strftime({d}, '%Y-%m-11-20')
     ELSE strftime({d}, '%Y-%m-21-') || day(last_day({d})) END"""


@check(
    "month_thirds",
    f"""SELECT {THIRD.format(d='d')} AS period, CAST(count(r.id) AS BIGINT) AS repositories
        FROM (SELECT CAST(m + to_days(o) AS DATE) AS d
              FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS m),
                   (VALUES (0), (10), (20)) v(o)) p
        LEFT JOIN (SELECT id, CAST(created_at AS DATE) AS c FROM repositories) r
          ON {THIRD.format(d='c')} = {THIRD.format(d='d')}
        GROUP BY 1""",
)
def month_thirds(spark, sf_dir):
    periods = C.month_thirds(spark, date(1995, 1, 1), date(2001, 12, 31)).select("period")
    counts = (
        repos(spark, sf_dir)
        .groupBy(D.month_third(F.to_date("created_at")).getField("period").alias("period"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return periods.join(counts, "period", "left").select(
        "period", F.coalesce("_n", F.lit(0)).cast("bigint").alias("repositories")
    )


@check(
    "adaptive_periods",
    """WITH p AS (SELECT CAST(range AS INTEGER) AS n, DATE '1997-03-01' + CAST(range AS INTEGER) * 5 AS s
                  FROM range(62))
       SELECT CAST(s AS VARCHAR) AS period_start, CAST(least(s + 5, DATE '1997-12-31') AS VARCHAR) AS period_end,
              count(r.id) AS repositories
       FROM p LEFT JOIN repositories r
         ON CAST(created_at AS DATE) >= s AND CAST(created_at AS DATE) <= DATE '1997-12-31'
        AND (CAST(created_at AS DATE) < s + 5 OR s + 5 >= DATE '1997-12-31')
       WHERE s < DATE '1997-12-31' GROUP BY s""",
)
def adaptive_periods(spark, sf_dir):
    start, end = date(1997, 3, 1), date(1997, 12, 31)
    own = D.adaptive_period(F.to_date("created_at"), start, end).getField("period_no").alias("period_no")
    counts = repos(spark, sf_dir).groupBy(own).agg(F.count(F.lit(1)).alias("_n"))
    return C.adaptive_periods(spark, start, end).join(counts, "period_no", "left").select(
        text("period_start"), text("period_end"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("repositories"),
    )


@check(
    "resume_periods",
    f"""SELECT DISTINCT {THIRD.format(d='created_at')} AS period FROM repositories
        WHERE created_at >= TIMESTAMP '1998-01-01'""",
)
def resume_periods(spark, sf_dir):
    thirds = repos(spark, sf_dir).withColumn(
        "period", D.month_third(F.to_date("created_at")).getField("period")
    )
    done = C.period_progress(thirds.where(F.col("created_at") < "1998-01-01"))
    return C.resume_periods(thirds.select("period").distinct(), done)


@check(
    "star_range_bucket",
    """SELECT CASE WHEN stargazers_count BETWEEN 10 AND 50 THEN 0 WHEN stargazers_count BETWEEN 50 AND 100 THEN 1
                   WHEN stargazers_count BETWEEN 100 AND 500 THEN 2 WHEN stargazers_count BETWEEN 500 AND 1000 THEN 3
                   WHEN stargazers_count BETWEEN 1000 AND 5000 THEN 4 ELSE 5 END AS bucket,
              count(*) AS repositories
       FROM repositories GROUP BY 1""",
)
def star_range_bucket(spark, sf_dir):
    bucket = D.star_range(F.col("stargazers_count")).cast("bigint").alias("bucket")
    return repos(spark, sf_dir).groupBy(bucket).agg(F.count(F.lit(1)).alias("repositories"))


AGES = ["DATE '2001-01-01'", "DATE '2000-06-30'", "DATE '1999-07-01'", "DATE '1996-07-01'"]


@check(
    "age_period_bucket",
    f"""WITH r AS (SELECT CAST(created_at AS DATE) AS d FROM repositories)
        SELECT CASE WHEN d >= {AGES[0]} THEN '0' WHEN d >= {AGES[1]} THEN '1' WHEN d >= {AGES[2]} THEN '2'
                    WHEN d >= {AGES[3]} THEN '3' END AS bucket, count(*) AS repositories
        FROM r GROUP BY 1""",
)
def age_period_bucket(spark, sf_dir):
    bucket = D.age_period(F.to_date("created_at"), AS_OF).cast("string").alias("bucket")
    return repos(spark, sf_dir).groupBy(bucket).agg(F.count(F.lit(1)).alias("repositories"))


# ---- strategies ----------------------------------------------------------------------------------------------
@check(
    "collect_by_time",
    f"""WITH r AS (SELECT *, CAST(created_at AS DATE) AS d FROM repositories
                   WHERE stargazers_count >= 100 AND created_at >= TIMESTAMP '1996-01-01'
                     AND created_at < TIMESTAMP '2001-07-02'),
             c AS (SELECT id, full_name, stargazers_count, fork, d, {THIRD.format(d='d')} AS own,
                          CASE WHEN day(d) IN (1, 11, 21) AND d > DATE '1996-01-01'
                               THEN {THIRD.format(d="(d - 1)")} END AS before FROM r),
             done AS (SELECT DISTINCT {THIRD.format(d='created_at')} AS period FROM repositories
                      WHERE month(created_at) = 3),
             t AS (SELECT id, full_name, stargazers_count, fork,
                          CASE WHEN before IS NOT NULL AND before NOT IN (SELECT period FROM done) THEN before
                               WHEN own NOT IN (SELECT period FROM done) AND d < DATE '2001-07-01' THEN own END AS period
                   FROM c)
        SELECT id, full_name, stargazers_count, period FROM t WHERE period IS NOT NULL AND NOT fork
        ORDER BY period, stargazers_count DESC, id LIMIT 1000""",
)
def collect_by_time(spark, sf_dir):
    everything = repos(spark, sf_dir)
    march = everything.where(F.month("created_at") == 3).withColumn(
        "period", D.month_third(F.to_date("created_at")).getField("period")
    )
    taken = C.collect_by_time(
        everything,
        everything.where("fork"),
        C.period_progress(march),
        AS_OF,
        min_stars=100,
        start_year=1996,
        total_limit=1000,
    )
    return taken.select("id", "full_name", "stargazers_count", "period")


@check(
    "collect_range",
    f"""WITH r AS (SELECT *, CAST(created_at AS DATE) - DATE '1997-03-01' AS off FROM repositories
                   WHERE stargazers_count >= 100
                     AND CAST(created_at AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-12-31'),
             m AS (SELECT {REPO}, fork, off // 5 AS period_no,
                          off % 5 <> 0 OR off = 0 AS first_time FROM r WHERE off // 5 <= 60
                   UNION ALL
                   SELECT {REPO}, fork, off // 5 - 1, true FROM r WHERE off % 5 = 0 AND off > 0)
        SELECT {REPO}, CAST(period_no AS BIGINT) AS period_no, first_time AND NOT fork AS is_new
        FROM m ORDER BY period_no, {BEST} LIMIT 1200""",
)
def collect_range(spark, sf_dir):
    everything = repos(spark, sf_dir)
    taken = C.collect_range(
        everything, everything.where("fork"), date(1997, 3, 1), date(1997, 12, 31), limit=1200
    )
    return taken.select(
        "id", "full_name", "stargazers_count", F.col("period_no").cast("bigint").alias("period_no"), "is_new"
    )


RANGE_ROWS = ", ".join(
    f"({n}, {low}, {'9e18' if high is None else high})" for n, (low, high) in enumerate(V.STAR_RANGES)
)


@check(
    "collect_diverse",
    f"""WITH a(age, oldest, youngest) AS (VALUES (0, {AGES[0]}, DATE '9999-01-01'), (1, {AGES[1]}, {AGES[0]}),
                                                 (2, {AGES[2]}, {AGES[1]}), (3, {AGES[3]}, {AGES[2]})),
             s(stars, low, high) AS (VALUES {RANGE_ROWS}),
             l(lang, language_name) AS (VALUES (0, 'python'), (1, 'javascript'), (3, 'go')),
             p AS (SELECT {REPO}, fork, (age * 8 + stars) * 10 + lang AS stratum
                   FROM repositories JOIN a ON CAST(created_at AS DATE) BETWEEN oldest AND youngest
                   JOIN s ON stargazers_count BETWEEN low AND high JOIN l ON lower(language) = language_name
                   WHERE forks_count >= 3),
             k AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {BEST}) AS rank FROM p),
             f AS (SELECT id, full_name, stargazers_count, min(stratum) AS stratum FROM k
                   WHERE rank <= 40 AND NOT fork GROUP BY 1, 2, 3),
             q AS (SELECT stratum, coalesce(sum(count(*)) OVER (ORDER BY stratum ROWS BETWEEN UNBOUNDED PRECEDING
                                                               AND 1 PRECEDING), 0) AS prior
                   FROM f GROUP BY stratum)
        SELECT id, full_name, stargazers_count, CAST(stratum AS BIGINT) AS stratum
        FROM f JOIN q USING (stratum) WHERE prior < 600""",
)
def collect_diverse(spark, sf_dir):
    everything = repos(spark, sf_dir)
    taken = C.collect_diverse(
        everything, everything.where("fork"), AS_OF, total_target=600, min_forks=3, per_stratum=40
    )
    return taken.select(
        "id", "full_name", "stargazers_count", F.col("stratum").cast("bigint").alias("stratum")
    )


@check(
    "collect_star_ranges",
    f"""WITH s(range_no, low, high) AS (VALUES (0, 10, 40), (1, 40, 100), (2, 100, 400), (3, 400, 9e18)),
             k AS (SELECT {REPO}, range_no, row_number() OVER (PARTITION BY range_no ORDER BY {BEST}) AS rank
                   FROM repositories JOIN s ON stargazers_count BETWEEN low AND high),
             f AS (SELECT * FROM k WHERE rank <= 300),
             q AS (SELECT range_no, coalesce(sum(count(*)) OVER (ORDER BY range_no ROWS BETWEEN UNBOUNDED PRECEDING
                                                                AND 1 PRECEDING), 0) AS prior
                   FROM f GROUP BY range_no)
        SELECT id, full_name, stargazers_count, CAST(range_no AS BIGINT) AS range_no
        FROM f JOIN q USING (range_no) WHERE prior < 300""",
)
def collect_star_ranges(spark, sf_dir):
    ranges = [(10, 40), (40, 100), (100, 400), (400, None)]
    taken = C.collect_star_ranges(repos(spark, sf_dir), ranges, 300)
    return taken.select(
        "id", "full_name", "stargazers_count", F.col("range_no").cast("bigint").alias("range_no")
    )
