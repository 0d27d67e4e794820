"""Column functions over names, locations and descriptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from . import fixed_values as V

# Letters, digits and underscore of any script; (?U) makes \s Unicode-aware too.
_SPECIAL = r"(?U)[^\p{L}\p{N}_\s,.\-]"
_SPACES = r"(?U)\s+"


def _squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, _SPECIAL, ""), _SPACES, " "))


def clean_location_strict(location: Column) -> Column:
    """Lower-cased place text, or null where the text names no place."""
    lowered = F.lower(location)
    cleaned = _squeeze(lowered)
    unusable = (
        lowered.isin("", *V.NON_LOCATIONS)
        | ((F.length(lowered) < 3) & ~lowered.rlike(r"^\p{L}+$"))
        | lowered.contains("://")
        | lowered.startswith("www.")
        | cleaned.isin(*V.NULL_WORDS)
        | ~cleaned.rlike(r"\p{L}")
    )
    return F.when(~unusable, cleaned)


def longest_part(parts: Column) -> Column:
    """Longest element of an array of texts; the first one on ties, null when empty."""
    return F.aggregate(
        parts,
        F.lit(None).cast("string"),
        lambda best, part: F.when(
            best.isNull() | (F.length(part) > F.length(best)), part
        ).otherwise(best),
    )


def clean_location_remote(location: Column) -> Column:
    """Place text in its own case; "Remote - X" style texts give their longest real part."""
    cleaned = _squeeze(location)
    lowered = F.lower(cleaned)
    remote = "|".join(V.REMOTE_WORDS)
    parts = F.transform(F.split(lowered, r"[-–—,/()]"), lambda part: F.trim(part))
    places = F.filter(parts, lambda part: (part != "") & ~part.rlike(remote))
    return (
        F.when(cleaned == "", None)
        .when(lowered.isin(*V.NON_LOCATIONS), None)
        .when(lowered.rlike(remote), longest_part(places))
        .otherwise(cleaned)
    )


def _first_hit(cases: list[tuple[Column, Column]]) -> Column:
    start = F.when(*cases[0])
    return reduce(lambda chain, case: chain.when(*case), cases[1:], start)


def country_substring(location: Column) -> Column:
    """Country code of the first city, else country word, occurring anywhere in the text."""
    lowered = F.lower(location)
    rules = V.pairs(V.SUBSTRING_CITIES) + V.pairs(V.SUBSTRING_COUNTRIES)
    return _first_hit([(lowered.contains(term), F.lit(code)) for term, code in rules])


def country_heuristic(location: Column) -> Column:
    """Struct (country_code, region) of the first term group with a hit in the raw text."""
    lowered = F.lower(location)
    cases = []
    for line in V.HEURISTIC_GROUPS.strip().splitlines():
        code, region, terms = (part.strip() for part in line.split("|"))
        hit = reduce(Column.__or__, [lowered.contains(t) for t in V.words(terms, ",")])
        cases.append((hit, F.struct(F.lit(code).alias("country_code"), F.lit(region).alias("region"))))
    return F.when(clean_location_remote(location).isNotNull(), _first_hit(cases))


def country_key(code: Column) -> Column:
    """Country code in the form the region tables use."""
    return F.upper(code)


def event_type_of(value: Column) -> Column:
    """The value where it is a known event type, else null."""
    return F.when(value.isin(*V.EVENT_TYPES), value)


def split_full_name(full_name: Column) -> Column:
    """Struct (owner, name) of an ``owner/name`` text."""
    return F.struct(
        F.split_part(full_name, F.lit("/"), F.lit(1)).alias("owner"),
        F.split_part(full_name, F.lit("/"), F.lit(2)).alias("name"),
    )


def truncate_utf8(text: Column, max_bytes: int = V.MAX_DESCRIPTION_BYTES) -> Column:
    """At most ``max_bytes`` of the text's UTF-8 form, never ending inside a character.

    A character takes up to four bytes, so one of the four cuts nearest the limit is valid.
    """
    raw = text.cast("binary")
    cuts = [
        F.substring(raw, 1, max(max_bytes - back, 0)).cast("string") for back in range(4)
    ]
    shortened = F.coalesce(*[F.when(F.is_valid_utf8(cut), cut) for cut in cuts])
    return F.when(F.octet_length(text) <= max_bytes, text).otherwise(shortened)
