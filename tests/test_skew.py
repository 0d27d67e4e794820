"""Heavy keys and limits of any size, without adaptive execution's help."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from forgemeter.operators import insights, reports, skew

TASKS = 8


@pytest.fixture
def no_skew_help(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", str(TASKS))
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def links(spark, n=40_000):
    """Nine tenths of the rows have key 7."""
    return spark.range(n).select(F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id") % 1000).alias("key"), F.col("id").alias("other"))


def task_sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]


def test_no_task_gets_much_more_than_the_median(spark, no_skew_help):
    names = spark.range(1000).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    plain = sorted(task_sizes(links(spark).join(names, "key")))
    assert plain[-1] > 0.85 * 40_000
    sizes = sorted(task_sizes(skew.join_heavy(links(spark), names, "key")))
    assert len(sizes) == TASKS and sum(sizes) == 40_000
    assert sizes[-1] <= 2 * sizes[TASKS // 2]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_heavy_join_equals_a_plain_join(spark, no_skew_help, how):
    rng = random.Random(1)
    left = [(rng.choice([1, 1, 1, 1, 2, 3, None, 9]), n % 50, "x" if n % 3 else None) for n in range(3000)]
    right = [(1, "one"), (1, "uno"), (2, "two"), (4, "four"), (None, "none")]
    a = spark.createDataFrame(left, "key long, n long, text string")
    b = spark.createDataFrame(right, "key long, name string")
    got, expected = skew.join_heavy(a, b, "key", how), a.join(b, "key", how)
    assert got.columns == expected.columns
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    assert skew.join_heavy(a.where("false"), b, "key", how).count() == 0


def test_only_heavy_keys_are_repeated(spark, no_skew_help):
    found = {r["key"]: r["_pieces"] for r in skew.heavy_keys(links(spark), "key", pieces=4).collect()}
    assert found == {7: 29}  # nine tenths of 8 tasks x 4 pieces, rounded up


def test_reports_along_hot_links(spark, no_skew_help):
    people = spark.range(300).select(F.col("id"), F.concat(F.lit("p"), "id").alias("login"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("C"), F.col("id") % 5)).alias("country_code"), F.lit("r").alias("region"))
    repos = spark.range(50).select(F.col("id"), F.concat(F.lit("o/"), "id").alias("full_name"), F.when(F.col("id") != 3, F.lit(1)).cast("long").alias("organization_id"))
    orgs = spark.createDataFrame([(1, "big"), (2, "small")], "id long, login string")
    pairs = spark.range(6000).select((F.col("id") % 300).alias("contributor_id"), F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id") % 50).alias("repository_id")).distinct()
    named = pairs.join(repos.withColumnRenamed("id", "repository_id"), "repository_id").join(people.withColumnRenamed("id", "contributor_id"), "contributor_id")
    got = {tuple(r) for r in reports.repository_contributors(repos, people, pairs).collect()}
    assert got == {(r["full_name"], r["login"]) for r in named.collect()}
    spread = {tuple(r) for r in insights.org_geo_spread(repos, pairs, people).collect()}
    of_org = named.where("organization_id = 1")
    assert spread == {(1, of_org.select("contributor_id").distinct().count(), of_org.select("country_code").where("country_code is not null").distinct().count())}
    assert reports.repos_with_org(repos, orgs).count() == 49
    diverse = {tuple(r) for r in insights.repo_diversity(pairs, people).collect()}
    assert diverse == {tuple(r) for r in named.where("country_code is not null").groupBy("repository_id").agg(F.count_distinct("country_code")).collect()}


@pytest.mark.parametrize("total", [0, 1, 999, 20_000, 39_999, 40_000, 50_000])
def test_first_rows_are_those_of_the_order(spark, no_skew_help, total):
    rows = spark.range(40_000).select("id", (F.col("id") * 7919 % 13).alias("stars"))
    order = [F.col("stars").desc(), "id"]
    got = {r["id"] for r in skew.first_rows(rows, total, order).collect()}
    assert got == {r["id"] for r in rows.orderBy(*order).limit(total).collect()}


def test_first_rows_evaluates_its_input_once_and_ranks_one_range(spark, no_skew_help):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 8000, 1, 4).select("id", (F.col("id") % 3).alias("stars")).mapInArrow(count, "id long, stars long")
    kept = skew.first_rows(rows, 3000, [F.col("stars").desc(), "id"])
    assert kept.count() == 3000
    assert seen.value <= 2 * 8000  # the sample that finds the ranges, and the write
    plan = kept._jdf.queryExecution().toString()
    assert "mapInArrow" not in plan
