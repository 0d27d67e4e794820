"""Shuffles whose number of tasks follows the tables, whatever the session's number of partitions is."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from compare import connect, difference, spark_rows, sql_rows
from forgemeter.operators import events as E, skew
from forgemeter.plans import archive_checks as C, report_checks  # noqa: F401 (registers its queries)
from forgemeter.plans.registry import QUERIES, SQL
from forgemeter.sources import sample_tables as S


@pytest.fixture
def two_partitions(spark, monkeypatch):
    """Tables of a thousand rows count as large, a task gets 500 of them, and the session shuffles into two."""
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in confs}
    monkeypatch.setattr(skew, "TASK_ROWS", 500)
    monkeypatch.setattr(skew, "MANY_ROWS", 1000)
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def task_sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]


def test_few_rows_are_left_to_the_session(spark):
    rows = spark.range(1000)
    assert skew.tasks_for(rows) is None and skew.dealt(rows, None, "id") is rows


def test_tasks_follow_the_rows(spark, two_partitions):
    assert [skew.tasks_for(spark.range(n)) for n in (999, 1000, 1001, 6000)] == [None, 2, 3, 12]


def test_events_of_a_task_do_not_grow_with_the_archive(spark, sf_dir, two_partitions):
    sizes = task_sizes(S.archive_events(spark, sf_dir))
    lines = S.table(spark, sf_dir, "lineitem").count()
    assert sum(sizes) == lines and max(sizes) < 2 * 500 < lines / 2


@pytest.mark.parametrize("name", ["org_yearly_stats", "org_yearly_simple", "commit_backfill", "organization_statistics", "country_yearly_stats"])
def test_statistics_by_size_agree_with_the_sql(spark, sf_dir, two_partitions, name):
    query = getattr(C, name)
    got = query(spark, sf_dir)
    assert difference(spark_rows(got), sql_rows(connect(sf_dir), SQL[name])) is None


def test_distinct_ids_are_dealt_by_size(spark, sf_dir, two_partitions):
    plan = C.org_yearly_stats(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    tasks = S.archive_tasks(spark, sf_dir)
    assert f"is_repo#" in plan and plan.count(f", {tasks}), REPARTITION_BY_NUM") == 3  # both sides of the join, and the ids


def test_rows_without_an_id_count_but_are_no_id(spark):
    parts = spark.createDataFrame(
        [(2020, "a", None, 1, 2, 3), (2020, "a", 1, None, 4, 5), (2020, "a", 1, 1, 0, 0), (2020, "b", None, None, 1, 0), (2020, "c", 7, 7, 0, 0)],
        "year long, organization_login string, repo_id long, actor_id long, forks long, stars long",
    )
    expected = [(2020, "a", 1, 6, 8, 1), (2020, "b", 0, 1, 0, 0), (2020, "c", 1, 0, 0, 1)]
    for tasks in (None, 3):
        assert sorted(map(tuple, E.merged_parts(parts, tasks).collect())) == expected


def test_commit_hashes_are_dealt_by_size(spark, sf_dir, two_partitions):
    tasks = S.archive_tasks(spark, sf_dir)
    for query, shuffles in ((C.org_yearly_commits, 3), (C.organization_statistics, 6)):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f", {tasks}), REPARTITION_BY_NUM") == shuffles  # the join's two, and the hashes or ids of each
    got = C.org_yearly_commits(spark, sf_dir)
    assert difference(spark_rows(got), sql_rows(connect(sf_dir), SQL["org_yearly_commits"])) is None


def test_commit_hashes_of_several_repositories_and_none(spark):
    """A hash counts once an organization; pushes without hashes or with unknown ones count none."""
    pushes = [("a", 1, ["x", "y", "x"]), ("a", 2, ["x"]), ("a", None, ["x", "z"]), ("b", 3, []), ("b", 3, None), ("c", 4, [None, "x"]), (None, 5, ["x"])]
    rows = spark.createDataFrame(pushes, "org string, repo long, shas array<string>").selectExpr(
        "'PushEvent' AS type", "timestamp'2020-05-01' AS created_at", "struct(repo AS id, struct(org AS login) AS organization) AS repo",
        "struct(transform(shas, s -> struct(s AS sha)) AS commits) AS payload",
    )
    for tasks in (None, 3):
        assert sorted(map(tuple, E.org_yearly_commits(rows, tasks=tasks).collect())) == [(2020, "a", 3), (2020, "b", 0), (2020, "c", 1)]


@pytest.mark.parametrize(
    "name",
    [
        "upsert_org_yearly_stats",
        "emerging_hubs",
        "export_country_stats",
        "upsert_country_yearly_stats",
    ],
)
def test_queries_on_the_yearly_table_deal_out_commit_hashes(spark, sf_dir, two_partitions, monkeypatch, name):
    asked, plain = [], E.org_yearly_commits
    monkeypatch.setattr(E, "org_yearly_commits", lambda events, *args: asked.append(args) or plain(events, *args))
    got = QUERIES[name](spark, sf_dir)
    assert asked == [(*C.YEARS, S.archive_tasks(spark, sf_dir))]
    assert difference(spark_rows(got), sql_rows(connect(sf_dir), SQL[name])) is None
