"""Collection strategies: which repositories of a candidate table to take, in which order.

Candidates are a repository table. Strata are derived from each row (no range joins), rank limits
are ``row_number() <= n`` so that Spark trims every stratum map-side before it shuffles.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions import dates as D, fixed_values as V
from .normalize import owner_split
from .reports import created_within, new_rows_only, search_repos, sorted_by
from .skew import first_rows
from .upsert import first_per_key


# ---- limits ------------------------------------------------------------------------------------
def top_n_per_stratum(df: DataFrame, strata: list[str], n: int, order: list[Column] | None = None) -> DataFrame:
    """The first n rows of every stratum, with their ``rank``."""
    ranked = W.partitionBy(*strata).orderBy(*(order or sorted_by()))
    return df.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= n)


def _running_quota(df: DataFrame, stratum: str) -> DataFrame:
    """(stratum, rows, prior): rows of all earlier strata. One row per stratum, a few thousand at
    most, so one ordered window over them is small."""
    counts = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("rows"))
    earlier = W.orderBy(stratum).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("prior", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))


def cap_whole_strata(df: DataFrame, stratum: str, total: int) -> DataFrame:
    """Strata in order until the total is reached; the one reaching it is kept whole."""
    kept = _running_quota(df, stratum).where(F.col("prior") < total).select(stratum)
    return df.join(kept, stratum, "left_semi")


def cap_total(df: DataFrame, stratum: str, total: int | None, order: list[Column] | None = None) -> DataFrame:
    """The first ``total`` rows by stratum and rank order; the input is evaluated once.

    The cut is found from counts of ranges of that order, so a stratum of any size, and a limit of any size, is no task's
    alone (see :func:`first_rows`).
    """
    return df if total is None else first_rows(df, total, [F.col(stratum), *(order or sorted_by())])


def dedupe_ids(df: DataFrame, order: Column, key: str = "id") -> DataFrame:
    """One row per id, the one seen first."""
    return first_per_key(df, [key], order)


# ---- periods -----------------------------------------------------------------------------------
def month_thirds(spark: SparkSession, first: date, last: date) -> DataFrame:
    """(period, first_day, end_day) for the three parts of every month from first to last."""
    months = F.explode(
        F.sequence(F.lit(first.replace(day=1)), F.lit(last.replace(day=1)), F.expr("interval 1 month"))
    ).alias("m")
    starts = F.explode(F.array(*[F.date_add("m", offset) for offset in (0, 10, 20)])).alias("d")
    return spark.range(1).select(months).select(starts).select(D.month_third(F.col("d")).alias("t")).select("t.*")


def adaptive_periods(spark: SparkSession, start: date, end: date) -> DataFrame:
    """(period_no, period_start, period_end) steps over [start, end]; none for an empty range."""
    step = D.adaptive_step(start, end)
    count = -(-(end - start).days // step)
    begin = F.date_add(F.lit(start), (F.col("id") * step).cast("int"))
    return spark.range(max(count, 0)).select(
        F.col("id").cast("int").alias("period_no"),
        begin.alias("period_start"),
        F.least(F.date_add(begin, step), F.lit(end)).alias("period_end"),
    )


def resume_periods(periods: DataFrame, progress: DataFrame) -> DataFrame:
    """The periods without a progress record."""
    return periods.join(progress.select("period"), "period", "left_anti")


def period_progress(collected: DataFrame) -> DataFrame:
    """The progress records of a collection: rows per period."""
    return collected.groupBy("period").agg(F.count(F.lit(1)).alias("num_repositories"))


# ---- strategies --------------------------------------------------------------------------------
def collect_by_time(
    candidates: DataFrame,
    stored: DataFrame,
    progress: DataFrame,
    as_of: date,
    min_stars: int = 10,
    start_year: int = 2014,
    total_limit: int | None = None,
) -> DataFrame:
    """New repositories by month-thirds up to the month of ``as_of``.

    Both ends of a third are inclusive, so the first day of one also belongs to the one before;
    the earlier of the two that is open takes it. Periods with progress records are skipped.
    """
    begin = date(start_year, 1, 1)
    end = (as_of.replace(day=1) + timedelta(days=31)).replace(day=1)
    day = F.to_date("created_at")
    rows = candidates.where(F.col("stargazers_count") >= min_stars).where(day.between(F.lit(begin), F.lit(end)))
    placed = rows.withColumn("_own", D.month_third(day)).withColumn(
        "_before",
        F.when((day == F.col("_own.first_day")) & (day > F.lit(begin)), D.month_third(F.date_sub(day, 1))),
    )
    # At most the 36 periods of each year of the range, so these may be broadcast; most rows have no
    # earlier period, and a shuffle by it would send them all to one task.
    known = month_thirds(candidates.sparkSession, begin, end).select("period")
    done = known.join(progress.select("period").distinct(), "period", "left_semi")
    for name in ("own", "before"):
        flags = done.select(F.col("period").alias(f"_{name}_period"), F.lit(True).alias(f"_{name}_done"))
        placed = placed.join(F.broadcast(flags), F.col(f"_{name}.period") == F.col(f"_{name}_period"), "left")
    chosen = F.when(F.col("_before").isNotNull() & F.col("_before_done").isNull(), F.col("_before.period")).when(
        F.col("_own_done").isNull() & (F.col("_own.first_day") < F.lit(end)), F.col("_own.period")
    )
    taken = placed.withColumn("period", chosen).where(F.col("period").isNotNull())
    fresh = new_rows_only(taken.select(*candidates.columns, "period"), stored)
    return cap_total(fresh, "period", total_limit)


def collect_range(
    candidates: DataFrame,
    stored: DataFrame,
    start: date,
    end: date,
    limit: int | None = None,
    min_stars: int = 100,
) -> DataFrame:
    """Repositories created in [start, end] by adaptive periods, best first within each.

    Known repositories are returned and count toward the limit. A shared bound day belongs to both
    periods: its repositories come up twice, ``is_new`` only the first time. A range no longer than
    one step (one day too) is one period.
    """
    day = F.to_date("created_at")
    rows = candidates.where(F.col("stargazers_count") >= min_stars).where(day.between(F.lit(start), F.lit(end)))
    span, step = (end - start).days, D.adaptive_step(start, end)
    if span > step:
        last = -(-span // step) - 1
        offset = F.datediff(day, F.lit(start))
        own = F.floor(offset / step).cast("int")
        member = F.array(F.when(offset % step == 0, own - 1), own)
        numbers = F.filter(member, lambda n: n.between(0, last))
    else:
        numbers = F.array(F.lit(0))
        step = span
    begin = F.date_add(F.lit(start), F.col("period_no") * step)
    listed = rows.withColumn("_numbers", numbers).withColumn("period_no", F.explode("_numbers"))
    known = stored.select("full_name", F.lit(True).alias("_known"))
    marked = (
        listed.join(known, "full_name", "left")
        .withColumn("period_start", begin)
        .withColumn("period_end", F.least(F.date_add(begin, step), F.lit(end)))
        .withColumn("is_new", F.col("_known").isNull() & (F.col("period_no") == F.get("_numbers", F.lit(0))))
    )
    result = marked.select(*candidates.columns, "period_no", "period_start", "period_end", "is_new")
    return cap_total(result, "period_no", limit)


def rows_to_store(collected: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New rows of a collection split into repositories, contributors and organizations."""
    return owner_split(collected.where(F.col("is_new")))


def _positions(tests: list[Column]) -> Column:
    """Positions of all tests that hold."""
    return F.array_compact(F.array(*[F.when(test, F.lit(at)) for at, test in enumerate(tests)]))


def _range_tests(ranges) -> list[Column]:
    stars = F.col("stargazers_count")
    return [stars >= low if high is None else stars.between(low, high) for low, high in ranges]


def collect_diverse(
    candidates: DataFrame,
    stored: DataFrame,
    as_of: date,
    total_target: int = 1000,
    languages: list[str] = V.SAMPLE_LANGUAGES,
    min_forks: int = 0,
    created_after: date | None = None,
    per_stratum: int | None = None,
) -> DataFrame:
    """New repositories over age x stars x language strata.

    Strata are visited by age, then stars, then language. Each offers its rows, or its
    best ``per_stratum``; of those, stored ids and ids met in an earlier stratum drop out. Visiting stops once the
    target is reached. Bounds are inclusive, so a row can lie in up to four strata.
    """
    day = F.to_date("created_at")
    ages = [day >= F.lit(created_after)] if created_after else D.age_period_tests(day, as_of)
    language = F.array_position(
        F.array(*[F.lit(name.lower()) for name in languages]), F.lower("language")
    )
    strata = (
        candidates.where(F.col("forks_count") >= min_forks)
        .withColumn("_language", language - 1)
        .where(F.col("_language") >= 0)
        .withColumn("_age", F.explode(_positions(ages)))
        .withColumn("_stars", F.explode(_positions(_range_tests(V.STAR_RANGES))))
        .withColumn(
            "stratum",
            ((F.col("_age") * len(V.STAR_RANGES) + F.col("_stars")) * len(languages) + F.col("_language")).cast("int"),
        )
        .drop("_language", "_age", "_stars")
    )
    best = strata if per_stratum is None else top_n_per_stratum(strata, ["stratum"], per_stratum).drop("rank")
    fresh = dedupe_ids(new_rows_only(best, stored), F.col("stratum"))
    return cap_whole_strata(fresh, "stratum", total_target)


def collect_star_ranges(
    candidates: DataFrame, ranges: list[tuple], limit: int, min_forks: int = 0
) -> DataFrame:
    """The best ``limit`` rows of each star range in order, until ``limit`` rows are reached."""
    placed = candidates.where(F.col("forks_count") >= min_forks).withColumn(
        "range_no", F.explode(_positions(_range_tests(ranges)))
    )
    return cap_whole_strata(top_n_per_stratum(placed, ["range_no"], limit), "range_no", limit)


def quality_union(
    candidates: DataFrame, stored: DataFrame, limit: int = 100, min_stars: int = 10, min_forks: int = 0
) -> DataFrame:
    """Top thirds by stars, forks and update time, each then cut to unknown repositories.

    A repository may appear under several strategies. Ordered by strategy and rank.
    """
    parts = []
    for number, sort in enumerate(("stars", "forks", "updated")):
        top = search_repos(
            candidates, min_stars=min_stars, min_forks=min_forks, sort=sort, max_results=limit // 3
        )
        parts.append(new_rows_only(top, stored, "full_name").withColumn("strategy", F.lit(number)))
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return union.orderBy(
        "strategy",
        F.when(F.col("strategy") == 0, F.col("stargazers_count")).desc_nulls_last(),
        F.when(F.col("strategy") == 1, F.col("forks_count")).desc_nulls_last(),
        F.when(F.col("strategy") == 2, F.col("updated_at")).desc_nulls_last(),
        "id",
    ).limit(limit)


def quality_repositories(
    candidates: DataFrame,
    stored: DataFrame,
    limit: int = 100,
    time_period: str | None = None,
    min_stars: int = 10,
    min_forks: int = 0,
) -> DataFrame:
    """:func:`quality_union` over the repositories of one month (``YYYY-MM``), else over all."""
    window = D.month_of(time_period) if time_period else None
    return quality_union(created_within(candidates, window), stored, limit, min_stars, min_forks)
