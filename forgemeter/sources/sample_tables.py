"""The analytics tables as fixed projections of an order-processing sample data set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import geo
from ..operators.skew import dealt, tasks_for

# The location text of each nation key.
LOCATIONS = [
    "San Francisco, CA", "Berlin, Germany", "Remote", "Remote - USA", "London", "Toronto, Canada",
    "Paris, France", "Austin, TX", "Kyiv, Ukraine", "Tbilisi, Georgia", "Lausanne",
    "https://example.com", "", None, "Singapore", "Munich", "the Netherlands", "Asia", "DE",
    "New Mexico", "São Paulo, Brazil", "🌍", "Sydney", "Bangalore, India", "Earth",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _location(nation: str) -> Column:
    texts = F.array(*[F.lit(text).cast("string") for text in LOCATIONS])
    return F.get(texts, F.col(nation))


def contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("login"),
        F.lit("User").alias("type"),
        _location("c_nationkey").alias("location"),
    )


def organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("login"),
        F.lit("Organization").alias("type"),
        _location("s_nationkey").alias("location"),
    )


def located(accounts: DataFrame) -> DataFrame:
    """Accounts with country, region and coordinates of their location."""
    places = geo.distinct_locations(accounts)
    countries = geo.resolve_locations(places)
    points = geo.location_info(places).select(
        "location", F.col("latitude").alias("location_lat"), F.col("longitude").alias("location_lon")
    )
    return _by_location(_by_location(accounts, countries), points)


def _by_location(accounts: DataFrame, facts: DataFrame) -> DataFrame:
    """A left join on the location; accounts without one get keys of their own and so many tasks."""
    key = geo.spread_null(F.col("location"), F.col("id"))
    facts = facts.withColumnRenamed("location", "_key")
    return accounts.withColumn("_key", key).join(facts, "_key", "left").drop("_key")


def with_countries(accounts: DataFrame) -> DataFrame:
    """Accounts with country and region of their location."""
    countries = geo.resolve_locations(geo.distinct_locations(accounts))
    return _by_location(accounts, countries)


def repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    languages = F.create_map(
        *[F.lit(text) for text in ("1", "Python", "2", "JavaScript", "3", "Go", "4", "")]
    )
    owners = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    name = F.concat(F.lit("repo-"), F.col("o_orderkey"))
    return (
        table(spark, sf_dir, "orders")
        .join(owners, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            name.alias("name"),
            F.concat("c_name", F.lit("/"), name).alias("full_name"),
            F.col("o_custkey").alias("owner_id"),
            F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey") % 10).alias("organization_id"),
            F.try_element_at(languages, F.substring("o_orderpriority", 1, 1)).alias("language"),
            (F.col("o_orderstatus") == "P").alias("fork"),
            F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("stargazers_count"),
            (F.col("o_orderkey") % 97).alias("forks_count"),
            F.col("o_orderdate").alias("created_at"),
            (
                F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 365).cast("int"))
            ).alias("updated_at"),
        )
    )


def archive_tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """How many tasks a shuffle of the archive's events takes."""
    return tasks_for(table(spark, sf_dir, "lineitem"))


def archive_events(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """The multi-year event archive in its nested form; ``lines`` may be a stream.

    Owner and organization names come by equi-joins without hints: both sides grow with the data,
    so Spark decides from their sizes whether one fits a broadcast. The join along the orders comes last, and is
    dealt out by the number of events: what follows it finds a repository's events in one task, of bounded size.
    """
    tasks = None  # a batch of a stream is a part of the table, and each task writes a file a year
    if lines is None:
        lines, tasks = table(spark, sf_dir, "lineitem"), archive_tasks(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orgs = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    kind = (
        F.when(F.col("l_returnflag") == "A", "PushEvent")
        .when(F.col("l_returnflag") == "N", "WatchEvent")
        .when(F.col("l_returnflag") == "R", "ForkEvent")
    )
    shas = F.transform(
        F.sequence(F.lit(1), (F.col("l_quantity") % 3 + 1).cast("int")),
        lambda i: F.struct(F.concat(F.col("l_partkey"), F.lit("-"), i).alias("sha")),
    )
    owned = orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    named = lines.withColumn("type", kind).join(orgs, F.col("l_suppkey") == F.col("s_suppkey"))
    flat = dealt(named, tasks, "l_orderkey").join(
        dealt(owned, tasks, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    # Structs are built in a step of their own, so that a query reading single fields of them
    # never builds the rest.
    return flat.select(
        F.concat_ws(
            "-",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        ).alias("id"),
        "type",
        F.col("l_shipdate").alias("created_at"),
        F.struct(F.col("o_custkey").alias("id"), F.col("c_name").alias("login")).alias("actor"),
        F.struct(
            F.col("l_orderkey").alias("id"),
            F.concat("c_name", F.lit("/repo-"), "l_orderkey").alias("name"),
            F.struct(F.when(F.col("l_partkey") % 7 != 0, F.col("s_name")).alias("login")).alias(
                "organization"
            ),
        ).alias("repo"),
        F.struct(F.when(F.col("l_returnflag") == "A", shas).alias("commits")).alias("payload"),
    )


EVENT_KINDS = [
    ("click", "PushEvent"),
    ("view", "WatchEvent"),
    ("purchase", "ForkEvent"),
    ("signup", "PullRequestEvent"),
    ("error", "BogusEvent"),
]


def events_from(rows: DataFrame) -> DataFrame:
    """Flat recent events; works on a batch or a stream of the raw event table."""
    kind = F.lit(None).cast("string")
    for raw, name in EVENT_KINDS:
        kind = F.when(F.col("event_type") == raw, name).otherwise(kind)
    return rows.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("created_at"),
        F.col("user_id").alias("actor_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("repo_id"),
        kind.alias("type"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_from(table(spark, sf_dir, "events"))


def contributor_repository(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .groupBy(F.col("actor_id").alias("contributor_id"), F.col("repo_id").alias("repository_id"))
        .agg(
            F.count(F.lit(1)).alias("contributions"),
            F.min("created_at").alias("first_contribution_at"),
            F.max("created_at").alias("last_contribution_at"),
        )
    )


def contributor_organization(spark: SparkSession, sf_dir: str) -> DataFrame:
    repos = repositories(spark, sf_dir).where(F.col("organization_id").isNotNull())
    pairs = events(spark, sf_dir).select("actor_id", "repo_id").distinct()
    return (
        pairs.join(repos, pairs["repo_id"] == repos["id"])
        .select(F.col("actor_id").alias("contributor_id"), "organization_id")
        .distinct()
    )


def _json_field(key: str, value: Column) -> Column:
    """``, "key": value``; the value is JSON text."""
    return F.concat(F.lit(f', "{key}": '), value)


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def repository_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories as JSON records in which some keys are absent and some values null."""
    key = F.col("id")
    owner = F.concat(
        F.lit('{"id": '),
        F.col("owner_id"),
        _json_field("login", _quoted(F.split_part("full_name", F.lit("/"), F.lit(1)))),
        F.when(key % 5 == 0, "").otherwise(
            _json_field("type", F.when(key % 5 == 1, '"Organization"').otherwise('"User"'))
        ),
        F.lit("}"),
    )
    record = F.concat(
        F.lit('{"id": '),
        key,
        _json_field("name", _quoted(F.col("name"))),
        _json_field("full_name", _quoted(F.col("full_name"))),
        F.when(key % 4 == 0, "").otherwise(
            _json_field("language", F.coalesce(_quoted(F.col("language")), F.lit("null")))
        ),
        F.when(key % 5 == 0, "").otherwise(_json_field("stargazers_count", F.col("stargazers_count"))),
        F.when(key % 6 == 0, "").otherwise(_json_field("owner", owner)),
        F.when(key % 3 == 0, _json_field("license", F.lit("null")))
        .when(key % 3 == 1, _json_field("license", F.lit('{"key": "mit"}')))
        .otherwise(""),
        F.when(key % 2 == 0, _json_field("topics", F.lit('["data", "spark"]'))).otherwise(""),
        F.when(key % 7 == 0, _json_field("default_branch", F.lit("null"))).otherwise(""),
        _json_field("fork", F.col("fork").cast("string")),
        F.lit("}"),
    )
    return repositories(spark, sf_dir).select("id", record.alias("json"))


def account_records(accounts: DataFrame) -> DataFrame:
    """Accounts as JSON records in which some keys are absent and some values null."""
    key = F.col("id")
    record = F.concat(
        F.lit('{"id": '),
        key,
        _json_field("login", _quoted(F.col("login"))),
        F.when(key % 2 == 0, "").otherwise(
            _json_field("location", F.coalesce(_quoted(F.col("location")), F.lit("null")))
        ),
        F.when(key % 3 == 0, "").otherwise(_json_field("type", F.lit('"Bot"'))),
        F.when(key % 4 == 0, "").otherwise(_json_field("public_repos", key % 50)),
        F.when(key % 4 == 0, "").otherwise(_json_field("contributions", key % 50)),
        F.when(key % 5 == 0, _json_field("is_verified", F.lit("true"))).otherwise(""),
        F.when(key % 5 == 0, _json_field("site_admin", F.lit("true"))).otherwise(""),
        F.lit("}"),
    )
    return accounts.select("id", record.alias("json"))


def pipeline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metrics record per hour of events."""
    hours = events(spark, sf_dir).groupBy(F.date_trunc("hour", "created_at").alias("timestamp")).agg(
        F.count(F.lit(1)).alias("events_processed"),
        F.count_distinct("actor_id").alias("api_calls"),
        F.count_distinct("repo_id").alias("db_operations"),
        F.count_if(F.col("type") == "BogusEvent").alias("errors"),
    )
    n = F.col("events_processed")
    return hours.withColumns({"throughput": n / 64, "memory_usage": n / 4, "cpu_usage": n / 8})


def run_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run summary per day of events; the type counts are a map in text form."""
    day = F.to_date("created_at").cast("string").alias("run")
    by_type = events(spark, sf_dir).groupBy(day, "type").agg(F.count(F.lit(1)).alias("n"))
    entry = F.concat(F.lit("'"), F.col("type"), F.lit("': "), F.col("n"))
    totals = by_type.groupBy("run").agg(
        F.sum("n").alias("total_events"),
        F.sum(F.when(F.col("type") == "BogusEvent", F.col("n")).otherwise(0)).alias("error_count"),
        F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(entry)), ", "), F.lit("}")).alias(
            "events_by_type"
        ),
    )
    n = F.col("total_events")
    return totals.select(
        "run",
        (n / 4).alias("duration_seconds"),
        (n / 8).alias("api_duration_seconds"),
        (n / 16).alias("bigquery_duration_seconds"),
        (n % 3).alias("repositories_processed"),
        "total_events",
        "events_by_type",
        (n / 32).alias("max_memory_mb"),
        "error_count",
    )
