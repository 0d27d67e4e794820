"""The analytics tables in SQL, over the sample data set, for checking the Spark versions.

``seed`` is the location golden table: text of a nation key and what each resolver must give.
"""

from __future__ import annotations

# Nation key, location text, substring rules, quick heuristic (country, region),
# full rules (country, region), location info (country, region, latitude, longitude).
GOLDEN = [
    (0, "San Francisco, CA", "US", None, None, "CA", "North America", "CA", "North America", None, None),
    (1, "Berlin, Germany", "DE", "DE", "Europe", "DE", "Europe", "DE", "Europe", None, None),
    (2, "Remote", None, None, None, None, None, None, None, None, None),
    (3, "Remote - USA", "US", "US", "North America", "US", "North America", None, None, None, None),
    (4, "London", "GB", None, None, "GB", "Europe", "GB", "Europe", 51.5074, -0.1278),
    (5, "Toronto, Canada", "CA", "CA", "North America", "CA", "North America", "CA", "North America", None, None),
    (6, "Paris, France", "FR", "FR", "Europe", "FR", "Europe", "FR", "Europe", None, None),
    (7, "Austin, TX", None, None, None, "US", "North America", None, None, None, None),
    (8, "Kyiv, Ukraine", "GB", "GB", "Europe", "UA", "Europe", "UA", None, None, None),
    (9, "Tbilisi, Georgia", None, None, None, "GE", None, "GE", "Asia", None, None),
    (10, "Lausanne", "US", "US", "North America", None, None, None, None, None, None),
    (11, "https://example.com", None, None, None, None, None, None, None, None, None),
    (12, "", None, None, None, None, None, None, None, None, None),
    (13, None, None, None, None, None, None, None, None, None, None),
    (14, "Singapore", None, None, None, "SG", "Asia", "SG", "Asia", None, None),
    (15, "Munich", None, "DE", "Europe", "DE", "Europe", None, None, None, None),
    (16, "the Netherlands", None, None, None, "NL", "Europe", None, None, None, None),
    (17, "Asia", None, None, None, None, None, None, "Asia", None, None),
    (18, "DE", None, None, None, None, None, "DE", "Europe", None, None),
    (19, "New Mexico", None, None, None, "MX", "North America", None, None, None, None),
    (20, "São Paulo, Brazil", "BR", "BR", "South America", "BR", "South America", "BR", "South America", None, None),
    (21, "🌍", None, None, None, None, None, None, None, None, None),
    (22, "Sydney", "AU", "AU", "Oceania", "AU", "Oceania", "AU", "Oceania", -33.8688, 151.2093),
    (23, "Bangalore, India", "IN", "IN", "Asia", "IN", "Asia", "IN", "Asia", None, None),
    (24, "Earth", None, None, None, None, None, None, None, None, None),
]


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, (int, float)) else "'" + value.replace("'", "''") + "'"


_SEED_ROWS = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in GOLDEN)

TABLES = {
    "seed": f"""
        SELECT k, CAST(location AS VARCHAR) AS location, a_code, b_code, b_region, c_code, c_region,
               d_code, d_region, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon
        FROM (VALUES {_SEED_ROWS}) t(k, location, a_code, b_code, b_region, c_code, c_region,
                                     d_code, d_region, lat, lon)""",
    "contributors": """
        SELECT c_custkey AS id, c_name AS login, s.location, s.c_code AS country_code,
               s.c_region AS region, s.lat AS location_lat, s.lon AS location_lon
        FROM customer JOIN seed s ON s.k = c_nationkey""",
    "organizations": """
        SELECT s_suppkey AS id, s_name AS login, s.location, s.c_code AS country_code,
               s.c_region AS region, s.lat AS location_lat, s.lon AS location_lon
        FROM supplier JOIN seed s ON s.k = s_nationkey""",
    "repositories": """
        SELECT o_orderkey AS id, 'repo-' || o_orderkey AS name,
               c_name || '/repo-' || o_orderkey AS full_name, o_custkey AS owner_id,
               CASE WHEN o_orderstatus = 'O' THEN o_orderkey % 10 END AS organization_id,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Python' WHEN '2' THEN 'JavaScript'
                    WHEN '3' THEN 'Go' WHEN '4' THEN '' END AS language,
               o_orderstatus = 'P' AS fork,
               CAST(floor(o_totalprice / 100) AS BIGINT) AS stargazers_count,
               o_orderkey % 97 AS forks_count, o_orderdate AS created_at,
               o_orderdate + to_days(CAST(o_orderkey % 365 AS INTEGER)) AS updated_at
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "archive": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
                 || CAST(round(l_extendedprice * 100) AS BIGINT) AS id,
               CASE l_returnflag WHEN 'A' THEN 'PushEvent' WHEN 'N' THEN 'WatchEvent'
                    WHEN 'R' THEN 'ForkEvent' END AS type,
               l_shipdate AS created_at, o_custkey AS actor_id, c_name AS actor_login,
               l_orderkey AS repo_id, c_name || '/repo-' || l_orderkey AS repo_name,
               CASE WHEN l_partkey % 7 <> 0 THEN s_name END AS organization_login,
               l_partkey, CAST(l_quantity % 3 + 1 AS INTEGER) AS n_commits
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
    "recent": """
        SELECT event_id AS id, ts AS created_at, user_id AS actor_id,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS repo_id,
               CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent'
                    WHEN 'purchase' THEN 'ForkEvent' WHEN 'signup' THEN 'PullRequestEvent'
                    WHEN 'error' THEN 'BogusEvent' END AS type
        FROM events""",
    "contributor_repository": """
        SELECT actor_id AS contributor_id, repo_id AS repository_id, count(*) AS contributions,
               min(created_at) AS first_contribution_at, max(created_at) AS last_contribution_at
        FROM recent GROUP BY 1, 2""",
    "contributor_organization": """
        SELECT DISTINCT actor_id AS contributor_id, organization_id
        FROM recent JOIN repositories r ON r.id = repo_id WHERE organization_id IS NOT NULL""",
    "org_stats": """
        SELECT CAST(year(created_at) AS BIGINT) AS year, organization_login,
               count(DISTINCT repo_id) AS number_repos,
               count(*) FILTER (type = 'ForkEvent') AS forks,
               count(*) FILTER (type = 'WatchEvent') AS stars,
               count(DISTINCT actor_id) AS number_contributors
        FROM archive
        WHERE organization_login IS NOT NULL
          AND created_at BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31'
          AND type IN ('ForkEvent', 'WatchEvent', 'PushEvent')
        GROUP BY 1, 2""",
    "org_commits": """
        SELECT CAST(year(created_at) AS BIGINT) AS year, organization_login,
               count(DISTINCT l_partkey || '-' || i) AS number_commits
        FROM archive, (VALUES (1), (2), (3)) c(i)
        WHERE organization_login IS NOT NULL AND i <= n_commits AND type = 'PushEvent'
          AND created_at BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31'
        GROUP BY 1, 2""",
    "org_push_stats": """
        SELECT CAST(year(created_at) AS BIGINT) AS year, organization_login,
               count(DISTINCT repo_id) AS number_repos,
               count(*) FILTER (type = 'ForkEvent') AS forks,
               count(*) FILTER (type = 'WatchEvent') AS stars,
               count(DISTINCT actor_login) FILTER (type = 'PushEvent') AS contributors,
               count(DISTINCT id) FILTER (type = 'PushEvent') AS number_commits
        FROM archive
        WHERE organization_login IS NOT NULL
          AND created_at BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31'
        GROUP BY 1, 2""",
    "organization_yearly_stats": """
        SELECT s.year, o.id AS organization_id, o.login, o.location, o.country_code, o.region,
               s.forks, s.stars, s.number_repos,
               coalesce(c.number_commits, 0) AS number_commits, s.number_contributors
        FROM org_stats s JOIN organizations o ON o.login = s.organization_login
        LEFT JOIN org_commits c ON c.year = s.year AND c.organization_login = s.organization_login""",
    "country_yearly_stats": """
        SELECT year, country_code, min(region) AS region, CAST(sum(forks) AS BIGINT) AS forks,
               CAST(sum(stars) AS BIGINT) AS stars, CAST(sum(number_repos) AS BIGINT) AS number_repos,
               CAST(sum(number_commits) AS BIGINT) AS number_commits,
               count(DISTINCT organization_id) AS number_organizations,
               CAST(sum(number_contributors) AS BIGINT) AS number_contributors
        FROM organization_yearly_stats WHERE country_code IS NOT NULL GROUP BY 1, 2""",
    "run_summaries": """
        SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS run, count(*) / 4.0 AS duration,
               count(*) / 8.0 AS api, count(*) / 16.0 AS bigquery, count(*) % 3 AS repositories,
               count(*) AS total_events, count(*) / 32.0 AS memory
        FROM recent GROUP BY 1""",
    "metrics": """
        SELECT date_trunc('hour', created_at) AS hour, count(*) AS n,
               count(DISTINCT actor_id) AS api_calls, count(DISTINCT repo_id) AS db_operations,
               count(*) FILTER (type = 'BogusEvent') AS errors
        FROM recent GROUP BY 1""",
}
