"""Fixed schemas of the entity, archive and derived tables, as DDL text."""

from __future__ import annotations

_ACCOUNT = """
id BIGINT, login STRING, name STRING, email STRING, type STRING, avatar_url STRING,
company STRING, blog STRING, location STRING, country_code STRING, region STRING, bio STRING,
twitter_username STRING, public_repos INT, public_gists INT, followers INT, following INT,
created_at TIMESTAMP, updated_at TIMESTAMP, location_lat DOUBLE, location_lon DOUBLE
"""

CONTRIBUTORS = _ACCOUNT
ORGANIZATIONS = _ACCOUNT + ", public_members INT"
REPOSITORIES = """
id BIGINT, name STRING, full_name STRING, owner_id BIGINT, organization_id BIGINT,
description STRING, homepage STRING, language STRING, private BOOLEAN, fork BOOLEAN,
default_branch STRING, size INT, stargazers_count INT, watchers_count INT, forks_count INT,
open_issues_count INT, created_at TIMESTAMP, updated_at TIMESTAMP, pushed_at TIMESTAMP
"""
CONTRIBUTOR_REPOSITORY = """
contributor_id BIGINT, repository_id BIGINT, contributions INT,
first_contribution_at TIMESTAMP, last_contribution_at TIMESTAMP
"""
CONTRIBUTOR_ORGANIZATION = "contributor_id BIGINT, organization_id BIGINT, joined_at TIMESTAMP"
ARCHIVE_EVENTS = """
id STRING, type STRING, created_at TIMESTAMP, actor STRUCT<id: BIGINT, login: STRING>,
repo STRUCT<id: BIGINT, name: STRING, organization: STRUCT<login: STRING>>,
payload STRUCT<commits: ARRAY<STRUCT<sha: STRING>>>, day STRING
"""
ORGANIZATION_YEARLY_STATS = """
year INT, organization_id BIGINT, location STRING, country_code STRING, region STRING,
forks BIGINT, stars BIGINT, number_repos BIGINT, number_commits BIGINT,
number_contributors BIGINT
"""
COUNTRY_YEARLY_STATS = """
year INT, country_code STRING, region STRING, forks BIGINT, stars BIGINT, number_repos BIGINT,
number_commits BIGINT, number_organizations BIGINT, number_contributors BIGINT
"""
PERIOD_PROGRESS = "period STRING, num_repositories BIGINT"
LOCATION_DIM = "location STRING, country_code STRING, region STRING, latitude DOUBLE, longitude DOUBLE"
PIPELINE_METRICS = """
timestamp TIMESTAMP, events_processed BIGINT, throughput DOUBLE, api_calls BIGINT,
db_operations BIGINT, memory_usage DOUBLE, cpu_usage DOUBLE, errors BIGINT
"""

RUN_SUMMARY = """
duration_seconds DOUBLE, api_duration_seconds DOUBLE, bigquery_duration_seconds DOUBLE,
repositories_processed BIGINT, total_events BIGINT, events_by_type STRING, max_memory_mb DOUBLE,
error_count BIGINT
"""
RUN_MEMORY = "timestamp STRING, memory_mb DOUBLE"
RUN_ERRORS = "timestamp STRING, component STRING, error STRING"

ENTITIES = {
    "contributors": CONTRIBUTORS,
    "organizations": ORGANIZATIONS,
    "repositories": REPOSITORIES,
    "contributor_repository": CONTRIBUTOR_REPOSITORY,
    "contributor_organization": CONTRIBUTOR_ORGANIZATION,
    "organization_yearly_stats": ORGANIZATION_YEARLY_STATS,
    "country_yearly_stats": COUNTRY_YEARLY_STATS,
    "period_progress": PERIOD_PROGRESS,
    "location_dim": LOCATION_DIM,
    "pipeline_metrics": PIPELINE_METRICS,
}
