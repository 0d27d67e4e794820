from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from forgemeter.functions import dates as D
from forgemeter.operators import collect as C, insights as X, normalize as J, reports as R, upsert as U

REPOS = "id long, full_name string, language string, stargazers_count long, forks_count long, organization_id long, created_at timestamp"


def repos(spark, rows):
    full = [(i, f"o/r{i}", lang, stars, forks, org, datetime.fromisoformat(day)) for i, lang, stars, forks, org, day in rows]
    return spark.createDataFrame(full, REPOS)


def json_rows(spark, *records):
    return spark.createDataFrame([(n, json.dumps(r) if isinstance(r, dict) else r) for n, r in enumerate(records)], "seq int, json string")


# ---- JSON records -------------------------------------------------------------------------------------
def test_absent_keys_take_defaults_and_nulls_stay(spark):
    rows = json_rows(
        spark,
        {"id": 1},
        {"id": 2, "name": None, "size": None, "default_branch": None, "visibility": None, "language": None,
         "topics": None, "license": None, "owner": {"id": 7, "login": None, "type": None}},
        {"id": 3, "html_url": "h", "url": "u", "fork": True, "license": {"key": "mit"}, "topics": ["a"],
         "owner": {"id": 8, "login": "x", "type": "Organization", "html_url": "oh"}},
        "no json", "[1]",
    )
    found = {r["id"]: r.asDict() for r in J.normalize_repository(rows).collect()}
    assert set(found) == {1, 2, 3}
    assert len(J.normalize_repository(rows).columns) == 28
    one, two, three = found[1], found[2], found[3]
    assert (one["name"], one["size"], one["default_branch"], one["visibility"], one["topics"]) == ("", 0, "main", "public", [])
    assert (one["owner_type"], one["owner_login"], one["owner_id"], one["language"], one["license"]) == ("User", "", None, "", None)
    assert (two["name"], two["size"], two["default_branch"], two["visibility"], two["topics"]) == (None, None, None, None, None)
    assert (two["owner_type"], two["owner_login"], two["owner_url"], two["language"]) == (None, None, "", "")
    assert (three["url"], three["api_url"], three["is_fork"], three["license"], three["owner_url"]) == ("h", "u", True, "mit", "oh")


def test_account_defaults(spark):
    rows = json_rows(spark, {"id": 1, "login": "a", "email": None})
    user = J.normalize_user(rows).first()
    assert (len(user), user["type"], user["email"], user["followers"], user["bio"]) == (18, "User", None, 0, "")
    org = J.normalize_organization(rows).first()
    assert (len(org), org["is_verified"], org["description"]) == (18, False, "")
    person = J.normalize_contributor(rows).first()
    assert tuple(person) == (1, "a", "", "User", False, 0, "")


def test_repo_bundle_has_one_row_per_repository_and_all_links(spark):
    people = spark.range(500).select("id", F.concat(F.lit("u"), "id").alias("login"))
    links = people.select(F.lit(1).cast("long").alias("repository_id"), F.col("id").alias("contributor_id"), F.lit(2).cast("long").alias("contributions"))
    links = links.unionByName(links.where("contributor_id < 3").withColumn("repository_id", F.lit(2).cast("long")))
    orgs = spark.createDataFrame([(9, "org", "Berlin")], "id long, login string, location string")
    table = repos(spark, [(1, "Go", 1, 1, 9, "2020-01-01"), (2, "Go", 1, 1, None, "2020-01-01"), (3, "Go", 1, 1, None, "2020-01-01")])
    bundles, known = J.repo_bundle(table, orgs, links, people)
    found = {r["id"]: (r["contributors_count"], r["contributions"], r["organization"] and r["organization"]["login"]) for r in bundles.collect()}
    assert bundles.count() == 3 and found == {1: (500, 1000, "org"), 2: (3, 6, None), 3: (0, 0, None)}
    assert known.where("repository_id = 1").count() == 500 and known.where("repository_id = 2").count() == 3


def test_owner_split_takes_one_record_per_owner(spark):
    rows = [(1, 7, None, "User"), (2, 7, "zed", "Organization"), (3, 7, "amy", "User"), (4, None, None, None)]
    table = spark.createDataFrame(rows, "id long, owner_id long, owner_login string, owner_type string")
    _, people, orgs = J.owner_split(table)
    assert [tuple(r) for r in people.collect()] == [(7, "zed", "zed", "Organization")]
    assert [tuple(r) for r in orgs.collect()] == [(7, "zed", "zed")]


def test_first_per_key_keeps_rows_without_an_order(spark):
    rows = spark.createDataFrame([(1, "x", None), (2, "b", 2), (2, "a", 1), (2, "c", None)], "id long, login string, seq int")
    assert sorted((r.id, r.login) for r in U.first_per_key(rows, ["id"], F.col("seq")).collect()) == [(1, "x"), (2, "a")]


# ---- upserts ---------------------------------------------------------------------------------------------
def test_repository_upsert_rules(spark):
    stored = spark.createDataFrame(
        [(1, "a/b", "Go", "text", True, 5, 1, datetime(2020, 1, 1))],
        "id long, full_name string, language string, description string, fork boolean, stargazers_count long, owner_id long, created_at timestamp",
    )
    updates = U.repository_updates(
        json_rows(
            spark,
            {"id": 1, "language": None, "created_at": "soon", "owner_id": 99},
            {"id": 1, "stargazers_count": 6, "created_at": ""},
            {"id": 2, "full_name": "c/d", "fork": None, "owner": {"id": 4}, "created_at": "2021-01-01T00:00:00Z"},
            {"id": 2, "stargazers_count": 3, "owner_id": 5},
            {"full_name": "no id"},
        )
    )
    expected = [
        (1, "a/b", None, "text", True, 6, 1, datetime(2020, 1, 1)),
        (2, "c/d", None, None, None, 3, 4, datetime(2021, 1, 1)),
    ]
    once = U.upsert_repositories(stored, updates)
    assert sorted(map(tuple, once.collect())) == expected
    assert sorted(map(tuple, U.upsert_repositories(once, updates).collect())) == expected


def test_inserts_are_idempotent(spark):
    stored = spark.createDataFrame([(1, "a")], "id long, login string")
    new = spark.createDataFrame([(1, "x"), (2, "b"), (2, "b")], "id long, login string")
    once = U.insert_contributors(stored, new, "login")
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "b")]
    assert U.insert_contributors(once, new, "login").count() == 2
    links = spark.createDataFrame([(1, 1, 5)], "contributor_id long, repository_id long, contributions long")
    more = spark.createDataFrame([(1, 1, 9), (2, 1, None)], links.schema)
    assert sorted(map(tuple, U.link_contributor_repo(links, more).collect())) == [(1, 1, 5), (2, 1, 0)]


def test_organization_description_becomes_bio(spark):
    stored = spark.createDataFrame([(1, "a", "b")], "id long, login string, bio string")
    new = spark.createDataFrame([(2, "c", "d")], "id long, login string, description string")
    assert sorted(map(tuple, U.insert_organizations(stored, new, "id", description_as_bio=True).collect()))[1] == (2, "c", "d")


def test_anti_and_semi_make_the_whole(spark):
    table = repos(spark, [(i, "Go", i, 1, None, "2020-01-01") for i in range(20)])
    stored = table.where("id % 3 = 0")
    new = R.new_rows_only(table, stored).count()
    assert new + table.join(stored.select("id"), "id", "left_semi").count() == 20


# ---- periods and strategies ----------------------------------------------------------------------------------
def test_month_thirds_know_leap_years_and_year_ends(spark):
    rows = [tuple(map(str, r)) for r in C.month_thirds(spark, date(2020, 2, 10), date(2020, 2, 11)).collect()]
    assert rows == [
        ("2020-02-01-10", "2020-02-01", "2020-02-11"),
        ("2020-02-11-20", "2020-02-11", "2020-02-21"),
        ("2020-02-21-29", "2020-02-21", "2020-03-01"),
    ]
    december = C.month_thirds(spark, date(2021, 12, 1), date(2021, 12, 31)).collect()[-1]
    assert tuple(map(str, december)) == ("2021-12-21-31", "2021-12-21", "2022-01-01")


@pytest.mark.parametrize(
    "start, end, count, step",
    [("2020-01-01", "2020-01-11", 10, 1), ("2020-01-01", "2020-02-05", 18, 2), ("2020-01-01", "2020-06-01", 31, 5),
     ("2020-01-01", "2022-01-01", 74, 10), ("2020-01-01", "2020-01-01", 0, 1)],
)
def test_adaptive_periods(spark, start, end, count, step):
    start, end = date.fromisoformat(start), date.fromisoformat(end)
    rows = C.adaptive_periods(spark, start, end).orderBy("period_no").collect()
    assert len(rows) == count
    if rows:
        assert (rows[0]["period_end"] - rows[0]["period_start"]).days == step
        assert rows[-1]["period_end"] == end


def test_boundary_day_goes_to_the_earlier_open_period(spark):
    table = repos(spark, [(1, "Go", 50, 1, None, "2020-03-11"), (2, "Go", 60, 1, None, "2020-03-12"), (3, "Go", 5, 1, None, "2020-03-12"), (4, "Go", 70, 1, None, "2020-01-01")])
    none = spark.createDataFrame([], "period string, num_repositories long")
    done = spark.createDataFrame([("2020-03-01-10", 4)], none.schema)
    stored = table.where("id = 2")

    def run(progress, **extra):
        rows = C.collect_by_time(table, stored, progress, date(2020, 4, 1), start_year=2020, **extra).collect()
        return {r["id"]: r["period"] for r in rows}

    assert run(none) == {1: "2020-03-01-10", 4: "2020-01-01-10"}
    assert run(done) == {1: "2020-03-11-20", 4: "2020-01-01-10"}
    assert run(none, total_limit=1) == {4: "2020-01-01-10"}


def test_range_collection_returns_known_rows_and_repeats_boundary_days(spark):
    table = repos(spark, [(1, "Go", 500, 1, None, "2020-01-02"), (2, "Go", 400, 1, None, "2020-01-01"), (3, "Go", 300, 1, None, "2020-01-03"), (4, "Go", 99, 1, None, "2020-01-02")])
    rows = C.collect_range(table, table.where("id = 2"), date(2020, 1, 1), date(2020, 1, 3)).collect()
    found = sorted((r["period_no"], r["id"], r["is_new"]) for r in rows)
    assert found == [(0, 1, True), (0, 2, False), (1, 1, False), (1, 3, True)]
    single = C.collect_range(table, table.where("id = 2"), date(2020, 1, 1), date(2020, 1, 2), limit=1).collect()
    assert [(r["id"], r["is_new"]) for r in single] == [(1, True)]
    for limit in (1000, 1001, None):
        day = C.collect_range(table, table, date(2020, 1, 2), date(2020, 1, 2), limit)
        assert [(r["id"], r["period_no"]) for r in day.collect()] == [(1, 0)]
        assert C.collect_range(table, table, date(2020, 1, 1), date(2020, 1, 3), limit).count() == 4


def test_star_ranges_give_bounds_to_the_lower_range(spark):
    df = spark.createDataFrame([(v,) for v in (9, 10, 50, 51, 100, 50000, 50001, 10**7)], "s long")
    assert [r[0] for r in df.select(D.star_range(F.col("s"))).collect()] == [None, 0, 0, 1, 1, 6, 7, 7]


def test_totals_agree_with_a_sorted_limit(spark):
    table = repos(spark, [(i, "Go", i * 7 % 50, 1, None, "2020-01-01") for i in range(300)]).withColumn("stratum", (F.col("id") % 7).cast("int"))
    for total in (0, 1, 42, 43, 100, 299, 300, 999):
        wanted = table.orderBy("stratum", F.desc("stargazers_count"), "id").limit(total)
        assert sorted(r["id"] for r in C.cap_total(table, "stratum", total).collect()) == sorted(r["id"] for r in wanted.collect())
    assert C.cap_total(table, "stratum", None).count() == 300


def test_diverse_collection_takes_whole_strata(spark):
    rows = [(i, "Python", 20 + i, 1, None, "2020-06-01") for i in range(10)] + [(100, "PYTHON", 50, 1, None, "2020-06-01"), (101, "Ruby", 9, 1, None, "2020-06-01"), (102, "Cobol", 50, 1, None, "2020-06-01"), (103, "Go", 70, 1, None, "2020-06-01")]
    table = repos(spark, rows)
    taken = C.collect_diverse(table, table.where("id = 3"), date(2020, 7, 1), total_target=1).collect()
    assert {r["id"] for r in taken} == {0, 1, 2, 4, 5, 6, 7, 8, 9, 100}
    assert len({r["stratum"] for r in taken}) == 1
    more = C.collect_diverse(table, table.where("id = 3"), date(2020, 7, 1), total_target=11).collect()
    assert {r["id"] for r in more} - {r["id"] for r in taken} == {103}


def test_top_n_is_trimmed_before_the_shuffle(spark):
    table = repos(spark, [(1, "Go", 1, 1, None, "2020-01-01")])
    plan = C.top_n_per_stratum(table, ["language"], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    top = R.top_repositories(table)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in top


# ---- reports ---------------------------------------------------------------------------------------------------
def test_reports_on_empty_tables(spark):
    none = repos(spark, [(1, "Go", 1, 1, None, "2020-01-01")]).where("id < 0")
    assert R.repo_date_range(none).count() == 0
    people = spark.createDataFrame([], "id long, location string, country_code string")
    assert tuple(R.location_coverage(people).first()) == (0, 0, 0, 0.0, 0.0, 0.0)
    assert R.stars_histogram(none).agg(F.sum("repositories")).first()[0] == 0


def test_histogram_of_equal_values(spark):
    table = repos(spark, [(i, "Go", 7, 1, None, "2020-01-01") for i in range(4)])
    full = [(r["bin"], r["repositories"]) for r in R.stars_histogram(table).collect() if r["repositories"]]
    assert full == [(25, 4)]


def test_organizations_without_repositories_stay(spark):
    orgs = spark.createDataFrame([(1, "a", "X", None, None), (2, "b", "Y", None, None), (3, "c", None, None, None)], "id long, login string, location string, location_lat double, location_lon double")
    table = repos(spark, [(1, "Go", 5, 1, 1, "2020-01-01"), (2, "Go", 6, 1, 1, "2020-01-01")])
    rows = [tuple(r) for r in R.organization_locations(orgs, table).collect()]
    assert rows == [("X", None, None, 2, 11), ("Y", None, None, 0, None)]


def test_growth_with_one_empty_side(spark):
    events = spark.createDataFrame([], "id long, created_at timestamp, actor_id long, repo_id long, type string")
    table = repos(spark, [(1, "Go", 5, 1, 1, "2020-01-01"), (2, "Go", 6, 1, 1, "2020-01-01")])
    rows = R.org_growth(events, table, datetime(2020, 2, 1), 365, 1).collect()
    assert [(r["new_members"], r["new_repositories"]) for r in rows] == [(0, 2)]


def test_lookup_of_unknown_organization_is_empty(spark):
    orgs = spark.createDataFrame([(1, "a")], "id long, login string")
    assert R.repos_of_org(repos(spark, [(1, "Go", 5, 1, 1, "2020-01-01")]), orgs, "zzz").count() == 0


def test_search_pages_do_not_overlap(spark):
    table = repos(spark, [(i, "Go", 5, 1, None, "2020-01-01") for i in range(25)])
    pages = [[r["id"] for r in R.search_repos(table, page=n, per_page=10).collect()] for n in (1, 2, 3)]
    assert sum(pages, []) == list(range(25))


def test_month_window_ignores_bad_text(spark):
    assert D.month_of("2020-12") == (date(2020, 12, 1), date(2021, 1, 1))
    assert D.month_of("soon") is None
    table = repos(spark, [(1, "Go", 5, 1, None, "2020-01-01")])
    assert R.created_within(table, D.month_of("soon")).count() == 1


def test_preset_ranges():
    now = datetime(2024, 1, 31)
    assert [(now - D.preset_range(p, now)[0]).days for p in ("week", "month", "year")] == [7, 30, 365]
    assert D.preset_range("custom", now, "2020-01-01", "2020-02-01") == (datetime(2020, 1, 1), datetime(2020, 2, 1))


def test_country_pairs_equal_brute_force(spark):
    people = spark.createDataFrame([(i, c, None) for i, c in enumerate(["DE", "FR", "US", None, "DE", "IN"])], "id long, country_code string, region string")
    pairs = [(p, r) for r in range(40) for p in range(6) if (r * 7 + p * 5) % 4 < 2]
    links = spark.createDataFrame(pairs, "contributor_id long, repository_id long")
    country = dict(enumerate(["DE", "FR", "US", None, "DE", "IN"]))
    expected = {}
    for r in range(40):
        here = sorted({country[p] for p, q in pairs if q == r and country[p]})
        for i, a in enumerate(here):
            for b in here[i + 1:]:
                expected[a, b] = expected.get((a, b), 0) + 1
    found = {(r[0], r[1]): r[2] for r in X.cross_border_pairs(links, people).collect()}
    assert found == expected
