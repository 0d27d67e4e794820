from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from forgemeter.functions import fixed_values as V, lookup as L, text as T
from forgemeter.operators import geo as G
from forgemeter.sources import entities as N

# Text, quick heuristic, full rules.
GOLDEN = [
    ("Ontario", "BR", None),
    ("Indiana", "IN", "US"),
    ("Córdoba", None, "AR"),
    ("Newcastle", None, "AU"),
    ("Hamilton", None, "NZ"),
    ("Los Angeles, LA", None, "LA"),
    ("City (US)", None, "US"),
    ("Portland, OR", None, "US"),
    ("Brooklyn, NY", None, "US"),
    ("somewhere, the Netherlands", None, "NL"),
    ("ulm", None, None),
    ("a1", None, None),
    ("n/a", None, None),
    ("www.example.org", None, None),
]


def texts(spark, values):
    return spark.createDataFrame([(value,) for value in values], "location string")


def test_golden_locations(spark):
    df = texts(spark, [row[0] for row in GOLDEN])
    heuristic = {
        r["location"]: r["code"]
        for r in df.select("location", T.country_heuristic(F.col("location"))["country_code"].alias("code")).collect()
    }
    rules = {r["location"]: r["country_code"] for r in G.resolve_locations(df).collect()}
    assert [(text, heuristic[text], rules[text]) for text, *_ in GOLDEN] == GOLDEN


def test_brackets_count_in_uncleaned_text(spark):
    df = texts(spark, ["City (US), Berlin", "City (XX), DE"])
    found = {r[0]: r[1] for r in df.select("location", G.coded_country(F.col("location"))).collect()}
    assert found == {"City (US), Berlin": "US", "City (XX), DE": None}


@pytest.mark.parametrize(
    "raw, strict, remote",
    [
        ("Köln / Düsseldorf", "köln düsseldorf", "Köln Düsseldorf"),
        ("USA (Remote)", "usa remote", None),
        ("Remote, Berlin, Paris", "remote, berlin, paris", "berlin"),
        ("München 🍺", "münchen", "München"),
        ("12345", None, "12345"),
        ("\t東京  都 ", "東京 都", "東京 都"),
        ("Not Specified", None, None),
        ("-", None, "-"),
        ("", None, None),
        (None, None, None),
    ],
)
def test_cleaning(spark, raw, strict, remote):
    df = texts(spark, [raw])
    row = df.select(
        T.clean_location_strict(F.col("location")), T.clean_location_remote(F.col("location"))
    ).first()
    assert tuple(row) == (strict, remote)


def test_given_cities_equal_built_in_cities(spark):
    rows = [(rank, city, code) for rank, (city, code) in enumerate(V.by_group(V.CITIES, ","))]
    cities = spark.createDataFrame(rows, "rank int, city string, country_code string")
    values = [city for _, city, _ in rows] + [f"{city}, xx" for _, city, _ in rows] + [
        "the hague", "parisian", "near berlin", "x, Paris", "Newcastle upon Tyne", "Hamilton", "Zzz", "a,b,c",
    ]
    df = texts(spark, sorted(set(values)))
    own = sorted(map(tuple, G.resolve_locations(df).collect()), key=repr)
    given = sorted(map(tuple, G.resolve_locations(df, cities=cities).collect()), key=repr)
    assert own == given and len(own) == len(set(values))


def test_every_city_of_the_list_has_its_country(spark):
    cities = G.default_cities()
    assert len(V.by_group(V.CITIES, ",")) == 425 and len(cities) == 422
    listed = hashlib.sha256("\n".join(f"{city}={code}" for city, code in cities).encode()).hexdigest()
    assert listed == "c7c3ea0bb53b3a06fab0c988375f36199a9d84e89fadfc35709aa4a1f0c67364"
    df = spark.createDataFrame(cities, "city string, code string")
    forms = [F.col("city"), F.upper("city"), F.concat("city", F.lit(", zz")), F.concat("city", F.lit(" zz"))]
    wrong = [~G.default_city(form).eqNullSafe(F.col("code")) for form in forms]
    assert df.where(wrong[0] | wrong[1] | wrong[2] | wrong[3]).collect() == []
    found = dict(map(tuple, G.resolve_locations(texts(spark, ["Accra", "Almaty", "Amman", "Aachen", "Algiers", "x, Caracas"])).select("location", "country_code").collect()))
    assert found == {"Accra": "GH", "Almaty": "KZ", "Amman": "JO", "Aachen": "DE", "Algiers": "DZ", "x, Caracas": "VE"}


def test_cache_wins_and_lookup_table_fills_gaps(spark):
    df = texts(spark, ["Berlin, Germany", "Remote", "Atlantis", "Port, Atlantis", "Toronto"])
    cache = spark.createDataFrame(
        [("Berlin, Germany", None, None), ("Remote", "FR", "Europe")],
        "location string, country_code string, region string",
    )
    service = spark.createDataFrame([("atlantis", "GR")], "text string, service_country string")
    found = {r["location"]: (r["country_code"], r["region"]) for r in G.resolve_locations(df, cache, service).collect()}
    assert found == {
        "Berlin, Germany": (None, None),
        "Remote": ("FR", "Europe"),
        "Atlantis": ("GR", "Europe"),
        "Port, Atlantis": ("GR", "Europe"),
        "Toronto": ("CA", "North America"),
    }


def test_cached_resolution_equals_fresh(spark):
    df = texts(spark, [row[0] for row in GOLDEN])
    fresh = G.resolve_locations(df)
    again = G.resolve_locations(df, cache=fresh)
    assert sorted(map(tuple, fresh.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)


def test_location_info_stages(spark):
    df = texts(spark, ["DEU", " Korea, Republic of ", "Viet Nam", "Antarctica", "Mumbai", "x, FR", "Chad", "south america"])
    found = {r["location"]: tuple(r)[1:] for r in G.location_info(df).collect()}
    assert found == {
        "DEU": ("DE", "Europe", None, None),
        " Korea, Republic of ": ("KR", "Asia", None, None),
        "Viet Nam": ("VN", "Asia", None, None),
        "Antarctica": ("AQ", None, None, None),
        "Mumbai": ("IN", "Asia", 19.076, 72.8777),
        "x, FR": ("FR", "Europe", None, None),
        "Chad": ("TD", "Africa", None, None),
        "south america": (None, "South America", None, None),
    }


def test_location_info_with_given_countries(spark):
    df = texts(spark, ["Utopia", "Town, Utopia", "Germany"])
    countries = spark.createDataFrame([("utopia", "UT")], "key string, country_code string")
    found = {r["location"]: r["country_code"] for r in G.location_info(df, countries).collect()}
    assert found == {"Utopia": "UT", "Town, Utopia": "UT", "Germany": None}


def test_region_views_differ(spark):
    df = spark.createDataFrame([("TR",), ("il",), ("RU",), ("GE",), ("PA",), (None,)], "code string")
    rows = df.select("code", G.region_of(F.col("code")), G.region_of(F.col("code"), "continent")).collect()
    assert [tuple(r) for r in rows] == [
        ("TR", "Middle East", "Asia"),
        ("il", "Middle East", None),
        ("RU", "Europe", None),
        ("GE", None, "Asia"),
        ("PA", "Central America", "North America"),
        (None, None, None),
    ]


def test_location_file_forms(spark, tmp_path):
    entries = {"A": ["DE", "Europe"], "B": None, "C": {"country_code": "FR", "region": "Europe"}, "D": [1], "E": [None, None]}
    (tmp_path / "cache.json").write_text(json.dumps(entries, indent=2))
    found = {r["location"]: (r["country_code"], r["region"]) for r in N.scan_location_dim(spark, str(tmp_path)).collect()}
    assert found == {
        "A": ("DE", "Europe"), "B": (None, None), "C": ("FR", "Europe"), "D": (None, None), "E": (None, None),
    }


def test_enrichment_modes(spark):
    people = spark.createDataFrame(
        [(1, "Berlin", None, None), (2, "Paris", "XX", "old"), (3, None, None, None), (4, "Atlantis", "YY", "old")],
        "id long, location string, country_code string, region string",
    )
    orgs = people.where("id < 0")
    fill = {r["id"]: (r["country_code"], r["is_updated"]) for r in G.enrich_entities(people, orgs)[0].collect()}
    assert fill == {1: ("DE", True), 2: ("XX", False), 3: (None, False), 4: ("YY", False)}
    redo = G.enrich_entities(people, orgs, update_existing=True)[0]
    assert {r["id"]: r["country_code"] for r in redo.collect()} == {1: "DE", 2: "FR", 3: None, 4: "YY"}
    assert [r["id"] for r in G.needs_geocoding(people, 1, True).collect()] == [1]


def test_dim_reports_on_empty_tables(spark):
    empty = spark.createDataFrame(
        [], "location string, country_code string, region string, latitude double, longitude double"
    )
    assert tuple(G.dim_stats(empty).first()) == (0, 0, 0, 0.0)
    assert tuple(G.dim_coverage(empty).first()) == (0, 0, 0, 0, None, None, None)


@pytest.mark.parametrize("limit, kept", [(1, "a"), (2, "a"), (3, "aé"), (4, "aé"), (6, "aé"), (7, "aé🌍"), (0, "")])
def test_truncation_never_splits_a_character(spark, limit, kept):
    df = spark.createDataFrame([("aé🌍",)], "t string")
    assert df.select(T.truncate_utf8(F.col("t"), limit)).first()[0] == kept


def test_lookups_by_bucket_equal_a_walk_of_the_list(spark):
    table = {f"name {n}": {"rank": n, "code": f"c{n}"} for n in range(700)} | {"é, ß": {"rank": 1, "code": "x"}}
    rows = texts(spark, [*table, "name", "name 700", "NAME 1", "", None])
    found = rows.select("location", L.constant_lookup(table, "struct<rank: int, code: string>")(F.col("location")).alias("v")).collect()
    assert {r["location"]: r["v"] and r["v"].asDict() for r in found} == {t: table.get(t) for t in [*table, "name", "name 700", "NAME 1", "", None]}
    assert texts(spark, ["a"]).select(L.constant_lookup({})(F.col("location"))).first()[0] is None


@pytest.mark.parametrize("text", ["a b c", "a  b", " a", "", "a, b c", "x,y", ",", "one"])
def test_runs_of_words(spark, text):
    row = texts(spark, [text]).select(L.word_runs(F.col("location"), 2).alias("runs"), L.leading_runs(F.col("location"), 2).alias("first")).first()
    words = text.split(" ")
    assert sorted(row["runs"]) == sorted(" ".join(words[i : i + n]) for i in range(len(words)) for n in (1, 2) if i + n <= len(words))
    closed = text + " "
    ends = {closed[:i] for i, c in enumerate(closed) if c in " ," and "," not in closed[:i] and closed[:i].count(" ") < 2}
    assert ends <= set(row["first"])


def test_a_text_costs_the_same_with_many_more_rules(spark):
    """Time of one resolution per text, 400 rules against 40,000; a walk of the list would take a hundred times as long."""
    import time

    rows = spark.range(20_000).select(F.concat(F.lit("place "), F.col("id") % 997, F.lit(" near town "), F.col("id") % 31).alias("location"))
    rows = rows.cache()
    rows.count()

    def seconds(rules):
        cities = [(f"place {n}", "XX") for n in range(rules)]
        best = 1e9
        for _ in range(3):
            start = time.perf_counter()
            assert rows.where(G.city_of(F.col("location"), cities) == "XX").count() == sum(n % 997 < rules for n in range(20_000))
            best = min(best, time.perf_counter() - start)
        return best

    few = seconds(400)
    assert seconds(40_000) < 6 * few + 2
    rows.unpersist()
