"""Checked queries: text functions, location resolution, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V, text as T
from ..operators import geo as G
from ..sources import sample_tables as S
from .registry import check


def _accounts(spark, sf_dir):
    return S.contributors(spark, sf_dir)


def _places(spark, sf_dir):
    return G.distinct_locations(_accounts(spark, sf_dir))


def _values(rows):
    literals = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)
    return f"(VALUES {literals})"


# ---- cleaning ------------------------------------------------------------------------------------
@check(
    "clean_location_strict",
    rf"""WITH l AS (SELECT id, lower(location) AS t FROM contributors),
              c AS (SELECT id, t, trim(regexp_replace(regexp_replace(t, '[^\p{{L}}\p{{N}}_\s,.\-]', '', 'g'), '\s+', ' ', 'g')) AS x
                    FROM l)
         SELECT id, CASE WHEN t IS NULL OR t = '' OR t IN (SELECT w FROM {_values([(w,) for w in V.NON_LOCATIONS])} v(w))
                           OR (length(t) < 3 AND NOT regexp_matches(t, '^\p{{L}}+$'))
                           OR contains(t, '://') OR starts_with(t, 'www.')
                           OR x IN ('na', 'n/a', 'null', 'none', 'nil', 'undefined', '-')
                           OR NOT regexp_matches(x, '\p{{L}}') THEN NULL ELSE x END AS cleaned
         FROM c""",
)
def clean_location_strict(spark, sf_dir):
    return _accounts(spark, sf_dir).select("id", T.clean_location_strict(F.col("location")).alias("cleaned"))


@check(
    "clean_location_remote",
    r"""SELECT id, CASE location WHEN 'Remote - USA' THEN 'usa' WHEN 'https://example.com' THEN 'httpsexample.com'
                  WHEN 'Remote' THEN NULL WHEN 'Earth' THEN NULL WHEN '🌍' THEN NULL WHEN '' THEN NULL
                  ELSE location END AS cleaned
        FROM contributors""",
)
def clean_location_remote(spark, sf_dir):
    return _accounts(spark, sf_dir).select("id", T.clean_location_remote(F.col("location")).alias("cleaned"))


@check(
    "longest_part",
    """WITH p AS (SELECT o_orderkey AS id, o_orderpriority AS a, o_orderstatus || '-open' AS b FROM orders)
       SELECT id, CASE WHEN length(b) > length(a) THEN b ELSE a END AS longest FROM p""",
)
def longest_part(spark, sf_dir):
    parts = F.array("o_orderpriority", F.concat("o_orderstatus", F.lit("-open")))
    return S.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), T.longest_part(parts).alias("longest")
    )


@check(
    "truncate_utf8",
    """WITH d AS (SELECT doc_id, 'é' || text || '€🌍' AS t FROM documents)
       SELECT doc_id, strlen(t) > 40 AS was_cut,
              (SELECT max(n) FROM range(length(t) + 1) r(n)
               WHERE n <= 41 AND strlen(substr(t, 1, CAST(n AS BIGINT))) <= 40) AS kept
       FROM d""",
)
def truncate_utf8(spark, sf_dir):
    long = F.concat(F.lit("é"), F.col("text"), F.lit("€🌍"))
    return S.table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(long) > 40).alias("was_cut"),
        F.length(T.truncate_utf8(long, 40)).cast("bigint").alias("kept"),
    )


@check(
    "event_type_of",
    "SELECT id, CASE WHEN type <> 'BogusEvent' THEN type END AS type FROM recent",
)
def event_type_of(spark, sf_dir):
    return S.events(spark, sf_dir).select("id", T.event_type_of(F.col("type")).alias("type"))


@check(
    "split_full_name",
    "SELECT id, split_part(full_name, '/', 1) AS owner, split_part(full_name, '/', 2) AS name FROM repositories",
)
def split_full_name(spark, sf_dir):
    parts = T.split_full_name(F.col("full_name")).alias("p")
    return S.repositories(spark, sf_dir).select("id", parts).select("id", "p.owner", "p.name")


@check(
    "country_key_upper",
    "SELECT id, country_code FROM contributors",
)
def country_key_upper(spark, sf_dir):
    rows = S.with_countries(_accounts(spark, sf_dir))
    return rows.select("id", T.country_key(F.lower("country_code")).alias("country_code"))


# ---- resolvers -------------------------------------------------------------------------------------
@check(
    "country_substring",
    "SELECT c_custkey AS id, a_code AS country_code FROM customer JOIN seed ON k = c_nationkey",
)
def country_substring(spark, sf_dir):
    return _accounts(spark, sf_dir).select("id", T.country_substring(F.col("location")).alias("country_code"))


@check(
    "country_heuristic",
    """SELECT c_custkey AS id, b_code AS country_code, b_region AS region
       FROM customer JOIN seed ON k = c_nationkey""",
)
def country_heuristic(spark, sf_dir):
    found = T.country_heuristic(F.col("location")).alias("h")
    return _accounts(spark, sf_dir).select("id", found).select("id", "h.country_code", "h.region")


@check(
    "country_rules",
    """SELECT DISTINCT location, CASE k WHEN 17 THEN NULL ELSE c_code END AS country_code
       FROM customer JOIN seed ON k = c_nationkey WHERE location IS NOT NULL AND location <> ''""",
)
def country_rules(spark, sf_dir):
    cleaned = T.clean_location_strict(F.col("location"))
    return _places(spark, sf_dir).select("location", G.country_rules(cleaned).alias("country_code"))


# Every rule of every list, in texts made of the orders: a rule's name whole, behind and before other words and parts.
def _rules():
    kinds = [("country", V.pairs(V.COUNTRY_NAMES)), ("state", [(w, "US") for w in V.words(V.US_STATES, ",")]), ("city", G.default_cities())]
    ends = [("end", [(code, code) for code, _ in V.by_group(V.WORLD_REGIONS)] + [(code.upper(), "US") for code in V.words(V.US_STATE_CODES)])]
    rows = [(kind, rank, name, code) for kind, listed in kinds + ends for rank, (name, code) in enumerate(listed)]
    return [(n, *row) for n, row in enumerate(rows)]


_FORMS = ["{}", "near {} town", "{} zz", "{}, zz", "zz, {}", "x {}", "({})", "  {}", "{}ville", "{} {}"]


def _rule_values():
    rows = ", ".join(f"({n}, '{kind}', {rank}, {_quoted(name)}, '{code}')" for n, kind, rank, name, code in _rules())
    forms = ", ".join(f"({n}, {_quoted(form)})" for n, form in enumerate(_FORMS))
    return f"""rules AS (SELECT * FROM (VALUES {rows}) v(n, kind, rank, name, code)),
               forms AS (SELECT * FROM (VALUES {forms}) v(form, pattern)),
               places AS (SELECT DISTINCT CASE WHEN o_orderkey % 3 = 0 THEN upper(replace(pattern, '{{}}', name)) ELSE replace(pattern, '{{}}', name) END AS location
                          FROM orders JOIN rules ON n = o_orderkey % {len(_rules())} JOIN forms ON form = o_custkey % {len(_FORMS)})"""


def _quoted(word):
    return "'" + word.replace("'", "''") + "'"


_RULE_CODES = r"""
    SELECT location, coalesce(
      (SELECT min(coded) FROM (SELECT coalesce(nullif(regexp_extract(upper(location), '\(([A-Z]{2})\)', 1), ''),
                                               nullif(regexp_extract(upper(location), '[\s,]([A-Z]{2})$', 1), '')) AS coded) c
       WHERE coded IN (SELECT name FROM rules WHERE kind = 'end' AND name = code)),
      (SELECT arg_min(code, rank) FROM rules WHERE kind = 'country' AND contains(' ' || lower(location) || ' ', ' ' || name || ' ')),
      CASE WHEN EXISTS (SELECT 1 FROM rules WHERE kind = 'state' AND contains(' ' || lower(location) || ' ', ' ' || name || ' '))
             OR upper(regexp_extract(location, '[\s,]([A-Za-z]{2})$', 1)) IN (SELECT upper(w) FROM states) THEN 'US' END,
      (SELECT arg_min(code, rank) FROM rules WHERE kind = 'city' AND starts_with(lower(location) || ' ', name)
         AND substr(lower(location) || ' ', length(name) + 1, 1) IN (' ', ','))) AS country_code
    FROM places"""


def _rule_places(spark, sf_dir):
    rules = spark.createDataFrame([(row[0], row[3]) for row in _rules()], "n int, name string")
    forms = spark.createDataFrame(list(enumerate(_FORMS)), "form int, pattern string")
    orders = S.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % len(_rules())).cast("int").alias("n"), (F.col("o_custkey") % len(_FORMS)).cast("int").alias("form"))
    text = F.replace(F.col("pattern"), F.lit("{}"), F.col("name"))
    text = F.when(F.col("o_orderkey") % 3 == 0, F.upper(text)).otherwise(text)
    return orders.join(rules, "n").join(forms, "form").select(text.alias("location")).distinct()


@check(
    "country_rules_of_the_lists",
    f"WITH {_rule_values()}, states AS (SELECT * FROM {_values([(w,) for w in V.words(V.US_STATE_CODES)])} v(w)) {_RULE_CODES}",
)
def country_rules_of_the_lists(spark, sf_dir):
    return _rule_places(spark, sf_dir).select("location", G.country_rules(F.col("location")).alias("country_code"))


@check(
    "country_last_part",
    """WITH t AS (SELECT DISTINCT k, location FROM customer JOIN seed ON k = c_nationkey
                  WHERE location IS NOT NULL AND location <> '')
       SELECT location, CASE k WHEN 1 THEN 'DE' WHEN 5 THEN 'CA' WHEN 6 THEN 'FR' WHEN 8 THEN 'UA'
                               WHEN 9 THEN 'GE' WHEN 20 THEN 'BR' WHEN 23 THEN 'IN' END AS country_code
       FROM t""",
)
def country_last_part(spark, sf_dir):
    cleaned = T.clean_location_strict(F.col("location"))
    return _places(spark, sf_dir).select("location", G.country_last_part(cleaned).alias("country_code"))


@check(
    "resolve_location",
    """SELECT DISTINCT location, CASE WHEN k % 5 = 2 THEN NULL ELSE c_code END AS country_code,
              CASE WHEN k % 5 = 2 THEN NULL WHEN k % 5 = 3 THEN 'cached' ELSE c_region END AS region
       FROM customer JOIN seed ON k = c_nationkey WHERE location IS NOT NULL AND location <> ''""",
)
def resolve_location(spark, sf_dir):
    """A cache knows some locations (with another region) and holds others as having no country."""
    nations = S.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("k"), S._location("c_nationkey").alias("location")
    )
    rules = G.resolve_locations(_places(spark, sf_dir))
    known = nations.where((F.col("k") % 5).isin(2, 3)).distinct().join(rules, "location")
    cache = known.select(
        "location",
        F.when(F.col("k") % 5 == 3, F.col("country_code")).alias("country_code"),
        F.when(F.col("k") % 5 == 3, F.lit("cached")).alias("region"),
    )
    return G.resolve_locations(_places(spark, sf_dir), cache=cache)


@check(
    "location_dim_lookup",
    """SELECT DISTINCT location, k % 2 = 0 AS is_hit, CASE WHEN k % 2 = 0 THEN c_code END AS cached_country_code
       FROM customer JOIN seed ON k = c_nationkey WHERE location IS NOT NULL AND location <> ''""",
)
def location_dim_lookup(spark, sf_dir):
    even = S.table(spark, sf_dir, "customer").where(F.col("c_nationkey") % 2 == 0).select(
        S._location("c_nationkey").alias("location")
    )
    cache = G.resolve_locations(G.distinct_locations(even))
    return G.lookup_locations(_places(spark, sf_dir), cache).select(
        "location", "is_hit", "cached_country_code"
    )


def _regions(text):
    return _values(V.by_group(text)) + " v(code, region)"


@check(
    "region_of_country_a",
    f"""SELECT c_custkey AS id, d_code AS country_code, v.region
        FROM customer JOIN seed ON k = c_nationkey LEFT JOIN {_regions(V.WORLD_REGIONS)} ON code = d_code""",
)
def region_of_country_a(spark, sf_dir):
    info = G.batch_locations(_accounts(spark, sf_dir)).select("id", "country_code")
    accounts = _accounts(spark, sf_dir).select("id").join(info, "id", "left")
    return G.region_of_country(accounts, "country_code", "world")


@check(
    "region_of_country_b",
    f"""SELECT c_custkey AS id, c_code AS country_code, v.region
        FROM customer JOIN seed ON k = c_nationkey LEFT JOIN {_regions(V.CONTINENTS)} ON code = c_code""",
)
def region_of_country_b(spark, sf_dir):
    rows = S.with_countries(_accounts(spark, sf_dir)).select("id", "country_code")
    return G.region_of_country(rows, "country_code", "continent")


INFO = "d_code AS country_code, d_region AS region, lat AS latitude, lon AS longitude"


@check(
    "location_info",
    f"""SELECT DISTINCT location, {INFO} FROM customer JOIN seed ON k = c_nationkey
        WHERE location IS NOT NULL AND location <> ''""",
)
def location_info(spark, sf_dir):
    return G.location_info(_places(spark, sf_dir))


@check(
    "batch_locations",
    f"""SELECT s_suppkey AS id, {INFO} FROM supplier JOIN seed ON k = s_nationkey
        WHERE location IS NOT NULL AND location <> ''""",
)
def batch_locations(spark, sf_dir):
    return G.batch_locations(S.organizations(spark, sf_dir))


# ---- enrichment -------------------------------------------------------------------------------------
@check(
    "backfill_country",
    """SELECT id, CASE WHEN id % 10 = 0 THEN 'XX' ELSE country_code END AS country_code,
              CASE WHEN id % 10 = 0 THEN NULL ELSE region END AS region,
              id % 10 <> 0 AND country_code IS NOT NULL AS is_updated
       FROM contributors""",
)
def backfill_country(spark, sf_dir):
    accounts = _accounts(spark, sf_dir).withColumns(
        {
            "country_code": F.when(F.col("id") % 10 == 0, F.lit("XX")),
            "region": F.lit(None).cast("string"),
        }
    )
    resolved = G.resolve_locations(G.distinct_locations(G.needs_geocoding(accounts)))
    return G.backfill_country(accounts, resolved).select("id", "country_code", "region", "is_updated")


@check(
    "enrich_entities",
    """SELECT 'contributor' AS kind, id, country_code, region FROM contributors
       UNION ALL SELECT 'organization', id, country_code, region FROM organizations""",
)
def enrich_entities(spark, sf_dir):
    empty = {name: F.lit(None).cast("string") for name in ("country_code", "region")}
    accounts = [
        df.withColumns(empty) for df in (_accounts(spark, sf_dir), S.organizations(spark, sf_dir))
    ]
    parts = [
        df.select(F.lit(kind).alias("kind"), "id", "country_code", "region")
        for kind, df in zip(("contributor", "organization"), G.enrich_entities(*accounts))
    ]
    return parts[0].unionByName(parts[1])


@check(
    "geocode_dim_stats",
    """WITH d AS (SELECT DISTINCT location, c_code FROM customer JOIN seed ON k = c_nationkey
                  WHERE location IS NOT NULL AND location <> '')
       SELECT count(*) AS total_entries, count(c_code) AS successful, count(*) - count(c_code) AS failed,
              count(c_code) / count(*) AS success_rate FROM d""",
)
def geocode_dim_stats(spark, sf_dir):
    return G.dim_stats(G.resolve_locations(_places(spark, sf_dir)))


@check(
    "geocode_dim_coverage",
    """WITH d AS (SELECT DISTINCT location, d_code, d_region, lat, lon FROM customer JOIN seed ON k = c_nationkey
                  WHERE location IS NOT NULL AND location <> '')
       SELECT count(*) AS total_entries, count(d_code) AS with_country, count(d_region) AS with_region,
              count(*) FILTER (lat IS NOT NULL AND lon IS NOT NULL) AS with_coordinates,
              round(count(d_code) / count(*) * 100, 2) AS country_percentage,
              round(count(d_region) / count(*) * 100, 2) AS region_percentage,
              round(count(lat) / count(*) * 100, 2) AS coordinates_percentage FROM d""",
)
def geocode_dim_coverage(spark, sf_dir):
    return G.dim_coverage(G.location_info(_places(spark, sf_dir)))
