from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forgemeter.functions import dates as D, text as T
from forgemeter.operators import events as E, metrics as M
from forgemeter.sinks import tables as K
from forgemeter.sources import archive as A, entities as N
from forgemeter.workspace import fresh_path

SCHEMA = """id string, type string, created_at timestamp, actor struct<id: bigint, login: string>,
repo struct<id: bigint, name: string, organization: struct<login: string>>,
payload struct<commits: array<struct<sha: string>>>"""


def event(number, kind, when, actor=1, repo=1, org="acme", shas=None):
    commits = None if shas is None else [(sha,) for sha in shas]
    return (
        str(number), kind, datetime.fromisoformat(when), (actor, f"user{actor}"),
        (repo, f"acme/repo{repo}", (org,)), (commits,),
    )


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        event(1, "PushEvent", "2020-05-01 10:00:00", 1, 1, shas=["a", "b"]),
        event(2, "PushEvent", "2020-05-02 10:00:00", 2, 1, shas=["b", None]),
        event(3, "WatchEvent", "2020-05-02 11:00:00", 3, 2),
        event(4, "ForkEvent", "2020-05-03 10:00:00", 3, 2),
        event(5, "IssuesEvent", "2020-05-03 11:00:00", 9, 9),
        event(6, "WatchEvent", "2020-12-31 00:00:00", 4, 2),
        event(7, "WatchEvent", "2020-12-31 10:00:00", 5, 3),
        event(8, "PushEvent", "2020-06-01 10:00:00", 6, 4, org=None, shas=["z"]),
        event(9, "PushEvent", "2020-06-01 10:00:00", 7, 5, org="beta", shas=[]),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_last_day_counts_only_at_midnight(events):
    rows = {r["organization_login"]: r.asDict() for r in E.org_yearly_stats(events, 2020, 2020).collect()}
    assert set(rows) == {"acme", "beta"}
    assert rows["acme"]["stars"] == 2 and rows["acme"]["forks"] == 1
    assert rows["acme"]["number_repos"] == 2 and rows["acme"]["number_contributors"] == 4


def test_commits_count_distinct_hashes(events):
    rows = {r["organization_login"]: r["number_commits"] for r in E.org_yearly_commits(events, 2020, 2020).collect()}
    assert rows == {"acme": 2, "beta": 0}


def test_push_variant_counts_all_types(events):
    acme = E.org_yearly_stats_push(events, 2020, 2030, datetime(2020, 7, 1)).where("organization_login = 'acme'").first()
    assert (acme["number_repos"], acme["contributors"], acme["number_commits"]) == (3, 2, 2)


def test_split_range_equals_whole(spark, events):
    later = events.withColumn("created_at", F.add_months("created_at", 12).cast("timestamp"))
    both = events.unionByName(later)
    whole = E.org_yearly_stats(both, 2020, 2021)
    parts = E.org_yearly_stats(both, 2020, 2020).unionByName(E.org_yearly_stats(both, 2021, 2021))
    # A year's end is only cut at the end of the range, so the parts lose the afternoon of Dec 31.
    assert whole.count() == parts.count()
    assert whole.agg(F.sum("stars")).first()[0] == parts.agg(F.sum("stars")).first()[0] + 1


def test_country_with_two_regions_keeps_first_label_and_last_metrics(spark):
    stats = spark.createDataFrame(
        [(2020, 1, "TR", "Asia", 1, 1, 1, 1, 1), (2020, 2, "TR", "Middle East", 5, 6, 7, 8, 9),
         (2020, 3, None, None, 1, 1, 1, 1, 1), (2020, 4, "", None, 1, 1, 1, 1, 1),
         (2020, 5, "TR", "Middle East", 5, 6, 7, 8, 9)],
        "year long, organization_id long, country_code string, region string, forks long, stars long, "
        "number_repos long, number_commits long, number_contributors long",
    )
    rows = [tuple(r) for r in E.country_yearly_stats(stats, 2020, 2020).collect()]
    assert rows == [(2020, "TR", "Asia", 10, 12, 14, 16, 2, 18)]


def test_metrics_of_an_idle_repository_are_zero(events):
    assert tuple(E.repo_metrics(events, "acme/none", datetime(2020, 5, 2, 12)).first()) == (0, 0, 0)
    assert tuple(E.repo_metrics(events, "acme/repo1", datetime(2020, 5, 2, 12)).first()) == (0, 1, 1)


def test_event_window_is_read_whole(events):
    def ids(since, limit=None):
        rows = E.repo_events(events, "acme/repo1", datetime(2020, 5, 3), datetime.fromisoformat(since), limit=limit)
        return sorted(r["id"] for r in rows.collect())

    assert ids("2020-05-01 09:00:00") == ["1", "2"]
    assert ids("2020-05-01 00:00:00") == ["1", "2"] and ids("2020-05-01 00:00:00", 1) == ["1"]


def test_archive_prunes_partitions_and_columns(spark, events):
    path = fresh_path(spark, "archive")
    A.write_archive(events, path)
    A.write_archive(events.withColumn("id", F.concat(F.lit("x"), "id")), path)
    found = A.scan_archive(spark, path, "20200501", "20200502", "2020-05-01 00:00:00", "2020-05-02 10:30:00")
    assert sorted(r["id"] for r in found.collect()) == ["1", "2", "x1", "x2"]
    stored = A.scan_archive(spark, path, "20200101", "20201231")
    plan = E.org_yearly_stats(stored, 2020, 2020)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "struct<type:string,created_at:timestamp,actor:struct<id:bigint>,repo:struct<" in plan
    assert "payload" not in plan
    assert E.org_yearly_stats(stored, 2020, 2020).count() == 2


def test_upserting_statistics_twice_changes_nothing(spark):
    from forgemeter.operators import upsert as U

    columns = "year long, organization_id long, location string, country_code string, region string, forks long, stars long, number_repos long, number_commits long, number_contributors long"
    stored = spark.createDataFrame([(2019, 1, "old", "DE", "Europe", 1, 1, 1, 9, 1)], columns)
    fresh = spark.createDataFrame(
        [(2019, 1, "new", "FR", "Europe", 2, 2, 2, None, 2), (2020, 1, "new", "FR", "Europe", 3, 3, 3, 4, 3)], columns
    )
    once = U.upsert_org_yearly_stats(stored, fresh)
    twice = U.upsert_org_yearly_stats(once, fresh)
    expected = [(2019, 1, "old", "DE", "Europe", 2, 2, 2, 0, 2), (2020, 1, "new", "FR", "Europe", 3, 3, 3, 4, 3)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == expected


def test_exports_keep_order_and_header(spark):
    stats = spark.createDataFrame(
        [(2021, 2, "x", "DE", "Europe", 1, 2, 3, 4, 5), (2020, 1, "y, z", "FR", "Europe", 1, 2, 3, 4, 5)],
        "year long, organization_id long, location string, country_code string, region string, forks long, stars long, number_repos long, number_commits long, number_contributors long",
    )
    orgs = spark.createDataFrame([(1, "acme"), (2, "beta")], "id long, login string")
    path = K.export_org_stats(stats, orgs, fresh_path(spark, "out"))
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert lines[0] == "Jahr,Organization,Location,Country,Region,Forks,Stars,Number Repos,Number Commits,Contributors"
    assert sorted(set(lines[1:]) - {lines[0]}) == ['2020,acme,"y, z",FR,Europe,1,2,3,4,5', "2021,beta,x,DE,Europe,1,2,3,4,5"]


def test_query_export_shapes(spark):
    repos = spark.createDataFrame([(1, "a/b", 5, 6)], "id long, full_name string, stargazers_count long, forks_count long")
    path = K.export_query_csv(repos, fresh_path(spark, "repos"))
    assert spark.read.csv(path, header=True).columns == [
        "id", "full_name", "description", "language", "stars", "forks", "created_at", "updated_at",
    ]
    with pytest.raises(ValueError):
        K.export_query_csv(repos.select("id"), fresh_path(spark, "none"))


def test_export_of_the_whole_catalog(spark):
    spark.range(3).createOrReplaceTempView("fm_three")
    report = {r["table"]: r["row_count"] for r in K.export_all_tables(spark, fresh_path(spark, "all")).collect()}
    spark.catalog.dropTempView("fm_three")
    assert report["fm_three"] == 3


def test_run_reports(spark, tmp_path):
    (tmp_path / "summary.csv").write_text(
        "duration_seconds,api_duration_seconds,bigquery_duration_seconds,repositories_processed,"
        "total_events,events_by_type,max_memory_mb,error_count\n"
        "4.0,1.5,0.5,0,8,\"{'PushEvent': 5, 'ForkEvent': 3}\",2.0,1\n"
    )
    (tmp_path / "errors.csv").write_text('timestamp,component,error\n2025-03-22 16:06:30.986734,job,"first\n\nsecond, ""quoted"""\n')
    summary = N.scan_metrics_csv(spark, str(tmp_path / "summary.csv"), "summary")
    assert tuple(M.run_ratios(summary).select("events_per_second", "mb_per_repository").first()) == (2.0, None)
    parts = {r["component"]: r["duration"] for r in M.timing_breakdown(summary, ["error_count"]).collect()}
    assert parts == {"api": 1.5, "bigquery": 0.5, "other": 2.0}
    counts = {r["event_type"]: r["count"] for r in M.event_type_counts(summary, ["error_count"]).collect()}
    assert counts == {"PushEvent": 5, "ForkEvent": 3}
    error = N.scan_metrics_csv(spark, str(tmp_path / "errors.csv"), "errors").first()
    assert error["timestamp"] == datetime(2025, 3, 22, 16, 6, 30, 986734)
    assert error["error"] == 'first\n\nsecond, "quoted"'


def test_summary_of_no_metrics_is_empty(spark):
    empty = spark.createDataFrame(
        [], "timestamp timestamp, events_processed long, throughput double, memory_usage double, errors long, api_calls long, db_operations long"
    )
    assert M.metrics_summary(empty).count() == 0


def test_event_types_and_names(spark):
    df = spark.createDataFrame([("GollumEvent", "a/b"), ("NoEvent", "c")], "t string, n string")
    rows = df.select(T.event_type_of(F.col("t")), T.split_full_name(F.col("n"))).collect()
    assert [(r[0], r[1]["owner"], r[1]["name"]) for r in rows] == [("GollumEvent", "a", "b"), (None, "c", "")]


def test_bad_timestamps_are_null(spark):
    df = spark.createDataFrame([("2020-01-01T00:00:00Z",), ("yesterday",), (None,)], "t string")
    assert [r[0] for r in df.select(D.parse_timestamp(F.col("t"))).collect()] == [datetime(2020, 1, 1), None, None]
