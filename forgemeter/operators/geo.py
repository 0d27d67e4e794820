"""Locations to countries and regions.

All resolvers share one job shape: take the *distinct* location texts, resolve each once with
column expressions, and join the small-per-text result back. A location shared by a third of all
accounts therefore costs one resolution; the distinct step combines map-side before it shuffles.

Rule tables are fixed lists (the longest has 425 rows), so they ride along as literals or broadcast
frames. Tables that come from the caller (gazetteers, caches) carry no broadcast hint: Spark picks
the join from their measured size.
"""

from __future__ import annotations

import functools

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.lookup import constant_lookup, first_ranked, leading_runs, longest_key, word_runs
from ..functions.text import clean_location_strict, country_key


# ---- regions ---------------------------------------------------------------------------------
def region_of(code: Column, view: str = "world") -> Column:
    """Region of a country code; null for codes the view does not know.

    ``world`` has Middle East and Central America and upper-cases the code first; ``continent``
    follows continents and takes the code as it is.
    """
    text, key = (V.WORLD_REGIONS, country_key(code)) if view == "world" else (V.CONTINENTS, code)
    return constant_lookup(dict(V.by_group(text)))(key)


def region_of_country(df: DataFrame, code: str, view: str = "world", into: str = "region") -> DataFrame:
    return df.withColumn(into, region_of(F.col(code), view))


# ---- rules -----------------------------------------------------------------------------------
# Rule tables are constants of the plan, looked up by the phrases of a text: what a text costs
# goes by its words, whatever the number of rules.
_RANKED = "struct<rank: int, code: string>"


def _ranked(rows: list[tuple[str, str]]) -> dict[str, dict]:
    """Rules by name; of a name that occurs twice the first counts."""
    table: dict[str, dict] = {}
    for rank, (name, code) in enumerate(rows):
        table.setdefault(name, {"rank": rank, "code": code})
    return table


def _set_of(words: list[str]) -> dict[str, bool]:
    return dict.fromkeys(words, True)


def coded_country(text: Column) -> Column:
    """Two capital letters in brackets or at the end, where they are a known country code."""
    known = constant_lookup(_set_of([code for code, _ in V.by_group(V.WORLD_REGIONS)]), "boolean")
    code = F.regexp_extract(F.upper(text), r"(?<=\()[A-Z]{2}(?=\))|(?<=[\s,])[A-Z]{2}$", 0)
    return F.when(known(code), code)


def named_country(text: Column) -> Column:
    """First country name, in order of precedence, that stands in the text as whole words.

    The whole text, a text ending in ", name" and "the name" are all cases of this one.
    """
    names = _ranked(V.pairs(V.COUNTRY_NAMES))
    return first_ranked(word_runs(F.lower(text), longest_key(names)), constant_lookup(names, _RANKED))


def us_state(text: Column) -> Column:
    """``US`` where a state name stands in the text, or a state code ends it."""
    names = _set_of(V.words(V.US_STATES, ","))
    is_name = constant_lookup(names, "boolean")
    is_code = constant_lookup(_set_of(V.words(V.US_STATE_CODES)), "boolean")
    code = F.lower(F.regexp_extract(text, r"(?<=[\s,])[A-Za-z]{2}$", 0))
    named = F.exists(word_runs(F.lower(text), longest_key(names)), lambda run: F.coalesce(is_name(run), F.lit(False)))
    return F.when(named | F.coalesce(is_code(code), F.lit(False)), F.lit("US"))


def default_cities() -> list[tuple[str, str]]:
    """Built-in (city, country) rows; a repeated city keeps its first place, its last country."""
    ranked: dict[str, str] = {}
    for city, code in V.by_group(V.CITIES, ","):
        ranked[city] = code
    return list(ranked.items())


def city_of(text: Column, cities: list[tuple[str, str]]) -> Column:
    """Country of the first of the (city, country) rules that the text equals or starts with."""
    names = _ranked(cities)
    return first_ranked(leading_runs(F.lower(text), longest_key(names)), constant_lookup(names, _RANKED))


def default_city(text: Column) -> Column:
    """Country of the first built-in city the text equals or starts with."""
    return city_of(text, default_cities())


def rank_cities(cities: DataFrame) -> DataFrame:
    """A caller's gazetteer (rank, city, country_code) with one row per city: the lowest rank
    and the country listed last."""
    return cities.groupBy("city").agg(
        F.min("rank").alias("rank"), F.max_by("country_code", "rank").alias("city_country")
    )


def _city_codes(df: DataFrame, key: str, texts: list[str], cities: DataFrame) -> DataFrame:
    """Adds ``<text>_city``: the best city of a caller's gazetteer each text starts with.

    A city can only match a prefix that ends before a comma or space, so every such prefix no
    longer than the longest city becomes an equi-join key; nothing is compared pairwise.
    """
    ranked = rank_cities(cities)
    longest = ranked.agg(F.max(F.length("city"))).scalar()

    def prefixes(text: Column) -> Column:
        closed = F.concat(F.lower(text), F.lit(" "))
        ends = F.filter(
            F.sequence(F.lit(2), F.least(F.length(closed), F.col("_longest") + 1)),
            lambda end: F.substring(closed, end, F.lit(1)).isin(" ", ","),
        )
        found = F.transform(ends, lambda end: F.substring(closed, F.lit(1), end - 1))
        return F.when(F.length(closed) >= 2, found).otherwise(F.array().cast("array<string>"))

    candidates = F.concat(
        *[
            F.transform(prefixes(F.col(text)), lambda city: F.struct(F.lit(text).alias("of"), city.alias("city")))
            for text in texts
        ]
    )
    best = (
        df.withColumn("_longest", longest)
        .select(key, F.explode(candidates).alias("c"))
        .select(key, "c.of", "c.city")
        .join(ranked, "city")
        .groupBy(key)
        .agg(
            *[
                F.min_by("city_country", F.when(F.col("of") == text, F.col("rank"))).alias(f"{text}_city")
                for text in texts
            ]
        )
    )
    return df.join(best, key, "left")


def country_rules(text: Column, city: Column | None = None) -> Column:
    """Country code of a cleaned place text: code, country name, US state, then city."""
    return F.coalesce(
        coded_country(text),
        named_country(text),
        us_state(text),
        default_city(text) if city is None else city,
    )


def last_part(text: Column) -> Column:
    """What follows the last comma; null for a text without one."""
    return F.when(text.contains(","), F.trim(F.element_at(F.split(text, ","), -1)))


def country_last_part(text: Column, city: Column | None = None) -> Column:
    return country_rules(last_part(text), city)


def spread_null(key: Column, row: Column) -> Column:
    """A join key whose nulls become distinct unmatched values, so they do not share one task."""
    return F.coalesce(key, F.concat(F.lit("\u0000"), row.cast("string")))


# ---- resolution jobs -------------------------------------------------------------------------
def distinct_locations(*frames: DataFrame, location: str = "location") -> DataFrame:
    """Every location text of the frames, once."""
    union = frames[0].select(location)
    for frame in frames[1:]:
        union = union.unionByName(frame.select(location))
    return union.where(F.col(location).isNotNull() & (F.col(location) != "")).distinct()


def resolve_locations(
    locations: DataFrame,
    cache: DataFrame | None = None,
    service: DataFrame | None = None,
    cities: DataFrame | None = None,
) -> DataFrame:
    """Distinct ``location`` texts to (location, country_code, region).

    In order: the cache (an exact hit counts even when it holds nulls), the rules on the cleaned
    text, the lookup table ``service(text, service_country)`` on the cleaned text, the rules on the
    text after its last comma, the lookup table on that part.
    """
    rows = locations if cache is None else lookup_locations(locations, cache)
    hit = F.lit(False) if cache is None else F.col("is_hit")
    texts = rows.withColumn(
        "text", F.when(~hit, clean_location_strict(F.col("location")))
    ).withColumn("tail", last_part(F.col("text")))
    text_city = tail_city = None
    if cities is not None:
        texts = _city_codes(texts, "location", ["text", "tail"], cities)
        text_city, tail_city = F.col("text_city"), F.col("tail_city")
    answers = [country_rules(F.col("text"), text_city), country_rules(F.col("tail"), tail_city)]
    if service is not None:
        for part in ("text", "tail"):
            found = service.select(
                F.col("text").alias("_key"), F.col("service_country").alias(f"{part}_found")
            )
            texts = texts.join(
                found, spread_null(F.col(part), F.col("location")) == F.col("_key"), "left"
            ).drop("_key")
        answers = [answers[0], F.col("text_found"), answers[1], F.col("tail_found")]
    resolved = texts.withColumn("_country", F.coalesce(*answers))
    country, region = F.col("_country"), region_of(F.col("_country"))
    if cache is not None:
        country = F.when(hit, F.col("cached_country_code")).otherwise(country)
        region = F.when(hit, F.col("cached_region")).otherwise(region)
    return resolved.select("location", country.alias("country_code"), region.alias("region"))


def lookup_locations(df: DataFrame, cache: DataFrame) -> DataFrame:
    """Adds cached_country_code, cached_region and is_hit by exact location text."""
    dim = cache.select(
        "location",
        F.col("country_code").alias("cached_country_code"),
        F.col("region").alias("cached_region"),
        F.lit(True).alias("_hit"),
    )
    return (
        df.join(dim, "location", "left")
        .withColumn("is_hit", F.col("_hit").isNotNull())
        .drop("_hit")
    )


# ---- full location info ----------------------------------------------------------------------
@functools.cache
def iso_countries() -> dict[str, str]:
    """Map from lower-cased ISO 3166 names and two- and three-letter codes to the code.

    Codes come from the JVM's own country list; only names that differ are listed by hand. A text
    that is both a name and a code counts as the name.
    """
    locale = SparkContext._active_spark_context._jvm.java.util.Locale
    names, codes = {}, {}
    for code in locale.getISOCountries():
        country = locale("", code)
        name = V.ISO_NAMES.get(code) or country.getDisplayCountry(locale.ENGLISH)
        names[name.lower()] = codes[code.lower()] = codes[country.getISO3Country().lower()] = code
    return {**codes, **names}


def _with_countries(texts: DataFrame, countries: DataFrame | None) -> DataFrame:
    """Adds the country a whole text and its tail name exactly."""
    if countries is None:
        iso = constant_lookup(iso_countries())
        return texts.withColumns({f"{part}_country": iso(F.col(part)) for part in ("text", "tail")})
    for part in ("text", "tail"):
        named = countries.select(
            F.col("key").alias("_key"), F.col("country_code").alias(f"{part}_country")
        )
        texts = texts.join(
            named, spread_null(F.col(part), F.col("location")) == F.col("_key"), "left"
        ).drop("_key")
    return texts


def location_info(locations: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """``location`` texts to (location, country_code, region, latitude, longitude).

    Stages, first hit wins: country name or ISO code, city with coordinates, continent, then the
    name or code after the last comma. ``countries`` (unique key, country_code) replaces the ISO
    table.
    """
    texts = locations.select(
        "location", F.lower(F.regexp_replace("location", r"(?U)^\s+|\s+$", "")).alias("text")
    ).withColumn("tail", last_part(F.col("text")))
    fields = ["country", "region", "lat", "lon"]
    places = {row[0]: dict(zip(fields, row[1:])) for row in V.PLACED_CITIES}
    place = "struct<country: string, region: string, lat: double, lon: double>"
    found = _with_countries(texts, countries).withColumns(
        {
            "city": constant_lookup(places, place)(F.col("text")),
            "continent": constant_lookup(V.CONTINENT_NAMES)(F.col("text")),
        }
    )
    named = F.col("text_country").isNotNull()
    placed = ~named & F.col("city").isNotNull()
    continent = ~named & ~placed & F.col("continent").isNotNull()
    staged = found.select(
        "location",
        F.when(named, F.col("text_country"))
        .when(placed, F.col("city.country"))
        .when(~continent, F.col("tail_country"))
        .alias("country_code"),
        F.when(placed, F.col("city.region")).when(continent, F.col("continent")).alias("_region"),
        F.when(placed, F.col("city.lat")).alias("latitude"),
        F.when(placed, F.col("city.lon")).alias("longitude"),
    )
    region = F.coalesce("_region", region_of(F.col("country_code"), "continent"))
    return staged.select("location", "country_code", region.alias("region"), "latitude", "longitude")


def batch_locations(entities: DataFrame, entity_id: str = "id", countries: DataFrame | None = None) -> DataFrame:
    """One row of location info per entity that has a location."""
    located = entities.where(F.col("location").isNotNull() & (F.col("location") != ""))
    info = location_info(distinct_locations(located), countries)
    return located.select(entity_id, "location").join(info, "location").select(
        entity_id, "country_code", "region", "latitude", "longitude"
    )


# ---- enrichment of entity tables -------------------------------------------------------------
def needs_geocoding(
    entities: DataFrame, max_items: int | None = None, update_existing: bool = False
) -> DataFrame:
    """Entities with a location and (unless all are to be redone) no country yet."""
    wanted = F.col("location").isNotNull()
    if not update_existing:
        wanted = wanted & F.col("country_code").isNull()
    pending = entities.where(wanted)
    return pending if max_items is None else pending.orderBy("id").limit(max_items)


def backfill_country(entities: DataFrame, resolved: DataFrame, pending: DataFrame | None = None) -> DataFrame:
    """Sets country and region where the resolved table knows a country; other rows unchanged.

    ``pending`` restricts the change to its ids. Adds ``is_updated`` for counting.
    """
    dim = resolved.where(F.col("country_code").isNotNull()).select(
        F.col("location").alias("_location"),
        F.col("country_code").alias("_country"),
        F.col("region").alias("_region"),
    )
    target = entities
    may_change = F.lit(True)
    if pending is not None:
        target = entities.join(
            pending.select("id", F.lit(True).alias("_pending")), "id", "left"
        )
        may_change = F.col("_pending").isNotNull()
    else:
        may_change = F.col("country_code").isNull()
    key = F.when(may_change, F.col("location"))
    joined = target.join(dim, spread_null(key, F.col("id")) == F.col("_location"), "left")
    changed = may_change & F.col("_country").isNotNull()
    columns = [
        F.when(changed, F.col("_country")).otherwise(F.col(name)).alias(name)
        if name == "country_code"
        else F.when(changed, F.col("_region")).otherwise(F.col(name)).alias(name)
        if name == "region"
        else F.col(name)
        for name in entities.columns
    ]
    return joined.select(*columns, changed.alias("is_updated"))


def enrich_entities(
    contributors: DataFrame,
    organizations: DataFrame,
    cache: DataFrame | None = None,
    service: DataFrame | None = None,
    cities: DataFrame | None = None,
    update_existing: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Both account tables with countries filled in, each distinct location resolved once."""
    pending = [needs_geocoding(df, update_existing=update_existing) for df in (contributors, organizations)]
    resolved = resolve_locations(distinct_locations(*pending), cache, service, cities)
    if not update_existing:
        return tuple(backfill_country(df, resolved) for df in (contributors, organizations))
    return tuple(
        backfill_country(df, resolved, todo)
        for df, todo in zip((contributors, organizations), pending)
    )


def dim_stats(dim: DataFrame) -> DataFrame:
    """Entries with and without a country, and the share that has one (0 when empty)."""
    total, found = F.count(F.lit(1)), F.count_if(F.col("country_code").isNotNull())
    return dim.agg(
        total.alias("total_entries"),
        found.alias("successful"),
        (total - found).alias("failed"),
        F.when(total > 0, found / total).otherwise(F.lit(0.0)).alias("success_rate"),
    )


def dim_coverage(dim: DataFrame) -> DataFrame:
    """Entries with country, region and coordinates; percentages are null for an empty table."""
    total = F.count(F.lit(1))
    parts = {
        "country": F.count_if(F.col("country_code").isNotNull() & (F.col("country_code") != "")),
        "region": F.count_if(F.col("region").isNotNull() & (F.col("region") != "")),
        "coordinates": F.count_if(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()),
    }
    return dim.agg(
        total.alias("total_entries"),
        *[count.alias(f"with_{name}") for name, count in parts.items()],
        *[
            F.when(total > 0, F.round(count / total * 100, 2)).alias(f"{name}_percentage")
            for name, count in parts.items()
        ],
    )
