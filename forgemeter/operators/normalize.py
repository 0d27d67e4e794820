"""JSON records from the hosting service to flat rows with fixed columns.

A record is one JSON text per row. A default stands in only for an *absent* key; an explicit null
stays null. Rows whose text is no JSON object are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# output column, JSON key, type, default where the key is absent (None = null)
REPOSITORY_FIELDS = [
    ("id", "id", "bigint", None),
    ("name", "name", "string", ""),
    ("full_name", "full_name", "string", ""),
    ("description", "description", "string", ""),
    ("url", "html_url", "string", ""),
    ("api_url", "url", "string", ""),
    ("created_at", "created_at", "string", ""),
    ("updated_at", "updated_at", "string", ""),
    ("pushed_at", "pushed_at", "string", ""),
    ("homepage", "homepage", "string", ""),
    ("size", "size", "bigint", 0),
    ("stargazers_count", "stargazers_count", "bigint", 0),
    ("watchers_count", "watchers_count", "bigint", 0),
    ("forks_count", "forks_count", "bigint", 0),
    ("open_issues_count", "open_issues_count", "bigint", 0),
    ("default_branch", "default_branch", "string", "main"),
    ("is_fork", "fork", "boolean", False),
    ("is_archived", "archived", "boolean", False),
    ("is_disabled", "disabled", "boolean", False),
    ("visibility", "visibility", "string", "public"),
]
OWNER_FIELDS = [
    ("owner_id", "id", "bigint", None),
    ("owner_login", "login", "string", ""),
    ("owner_type", "type", "string", "User"),
    ("owner_url", "html_url", "string", ""),
    ("owner_avatar_url", "avatar_url", "string", ""),
]
_PROFILE_FIELDS = [
    ("company", "company", "string", ""),
    ("blog", "blog", "string", ""),
    ("location", "location", "string", ""),
    ("email", "email", "string", ""),
    ("twitter_username", "twitter_username", "string", ""),
    ("public_repos", "public_repos", "bigint", 0),
    ("public_gists", "public_gists", "bigint", 0),
    ("followers", "followers", "bigint", 0),
    ("following", "following", "bigint", 0),
    ("created_at", "created_at", "string", ""),
    ("updated_at", "updated_at", "string", ""),
    ("avatar_url", "avatar_url", "string", ""),
]
_ACCOUNT_FIELDS = [
    ("id", "id", "bigint", None),
    ("login", "login", "string", ""),
    ("name", "name", "string", ""),
    ("url", "html_url", "string", ""),
]
USER_FIELDS = (
    _ACCOUNT_FIELDS + [("type", "type", "string", "User"), ("bio", "bio", "string", "")] + _PROFILE_FIELDS
)
ORGANIZATION_FIELDS = (
    _ACCOUNT_FIELDS
    + [("description", "description", "string", ""), ("is_verified", "is_verified", "boolean", False)]
    + _PROFILE_FIELDS
)
CONTRIBUTOR_FIELDS = [
    ("id", "id", "bigint", None),
    ("login", "login", "string", ""),
    ("url", "html_url", "string", ""),
    ("type", "type", "string", "User"),
    ("site_admin", "site_admin", "boolean", False),
    ("contributions", "contributions", "bigint", 0),
    ("avatar_url", "avatar_url", "string", ""),
]


def record_schema(fields) -> str:
    return ", ".join(f"`{key}`: {kind}" for _, key, kind, _ in fields)


def records(df: DataFrame, column: str, schema: str, *kept: str) -> DataFrame:
    """JSON objects as one typed struct ``r`` and their top-level ``keys``.

    The keys tell an absent value from a null one; text that is no JSON object has none.
    """
    text = F.col(column)
    return df.select(
        *kept,
        text.alias("_json"),
        F.json_object_keys(text).alias("keys"),
        F.from_json(text, f"struct<{schema}>").alias("r"),
    ).where(F.col("keys").isNotNull())


def has_key(key: str) -> Column:
    return F.array_contains("keys", key)


def _default(name: str, value: Column, absent: Column, kind: str, default) -> Column:
    """The value; keys are only looked at where it is null."""
    if default is None:
        return value.alias(name)
    return F.coalesce(value, F.when(absent, F.lit(default).cast(kind))).alias(name)


def _fields(specs) -> list[Column]:
    return [
        _default(name, F.col(f"r.{key}"), ~has_key(key), kind, default)
        for name, key, kind, default in specs
    ]


def normalize_repository(df: DataFrame, column: str = "json") -> DataFrame:
    """28 columns; the owner is flattened, ``license`` is its key, a null language is ''."""
    schema = ", ".join(
        [
            record_schema(REPOSITORY_FIELDS),
            "language: string, license: struct<key: string>, topics: array<string>",
            f"owner: struct<{record_schema(OWNER_FIELDS)}>",
        ]
    )
    no_topics = F.when(~has_key("topics"), F.array().cast("array<string>"))
    owner_keys = F.json_object_keys(F.get_json_object("_json", "$.owner"))
    owner = [
        _default(
            name,
            F.col(f"r.owner.{key}"),
            ~F.coalesce(F.array_contains(owner_keys, key), F.lit(False)),
            kind,
            default,
        )
        for name, key, kind, default in OWNER_FIELDS
    ]
    return records(df, column, schema).select(
        *_fields(REPOSITORY_FIELDS),
        F.col("r.license.key").alias("license"),
        F.coalesce("r.language", F.lit("")).alias("language"),
        F.coalesce("r.topics", no_topics).alias("topics"),
        *owner,
    )


def normalize_user(df: DataFrame, column: str = "json") -> DataFrame:
    return records(df, column, record_schema(USER_FIELDS)).select(*_fields(USER_FIELDS))


def normalize_organization(df: DataFrame, column: str = "json") -> DataFrame:
    return records(df, column, record_schema(ORGANIZATION_FIELDS)).select(*_fields(ORGANIZATION_FIELDS))


def normalize_contributor(df: DataFrame, column: str = "json") -> DataFrame:
    return records(df, column, record_schema(CONTRIBUTOR_FIELDS)).select(*_fields(CONTRIBUTOR_FIELDS))


def owner_split(repositories: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Normalised repositories to (repositories with organization_id, contributors, organizations).

    Every owner becomes a contributor named by its login; organizations get a row of their own.
    One row per id: login and type come from one record, that of the lowest repository id with a
    login. They are combined map-side, so an owner of very many repositories is no hot spot.
    """
    is_org = F.col("owner_type") == "Organization"
    repos = repositories.withColumn("organization_id", F.when(is_org, F.col("owner_id")))
    account = F.struct(F.col("owner_login").alias("login"), F.col("owner_type").alias("type"))
    order = F.struct(F.col("owner_login").isNull(), F.col("owner_type").isNull(), "id", "owner_login", "owner_type")
    owned = repositories.where(F.col("owner_id").isNotNull()).groupBy(F.col("owner_id").alias("id"))
    owners = owned.agg(F.min_by(account, order).alias("account")).select("id", "account.*")
    contributors = owners.select("id", "login", F.col("login").alias("name"), "type")
    organizations = owners.where(F.col("type") == "Organization").select(
        "id", "login", F.col("login").alias("name")
    )
    return repos, contributors, organizations


def repo_bundle(
    repositories: DataFrame, organizations: DataFrame, links: DataFrame, contributors: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Repositories with their organization and totals, and their contributors as a table keyed by repository.

    One row per repository, with ``contributors_count`` and ``contributions``, and one row per link of a
    known contributor: no list grows with a popular repository, and totals are combined map-side.
    """
    people = contributors.select(F.col("id").alias("contributor_id"), "login")
    known = links.select("repository_id", "contributor_id", "contributions").join(people, "contributor_id")
    known = known.select("repository_id", "contributor_id", "login", "contributions")
    totals = known.groupBy(F.col("repository_id").alias("id")).agg(
        F.count(F.lit(1)).alias("contributors_count"), F.sum("contributions").alias("contributions")
    )
    orgs = organizations.select(
        F.col("id").alias("_org"), F.struct("id", "login", "location").alias("organization")
    )
    # Repositories without an organization get keys of their own instead of sharing the null.
    org_key = F.coalesce("organization_id", -F.col("id") - 1)
    bundles = (
        repositories.withColumn("_org", org_key)
        .join(orgs, "_org", "left")
        .drop("_org")
        .join(totals, "id", "left")
        .na.fill(0, ["contributors_count", "contributions"])
    )
    return bundles, known


def repo_names(repositories: DataFrame) -> DataFrame:
    return repositories.select("full_name")
