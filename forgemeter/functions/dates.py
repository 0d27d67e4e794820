"""Column functions over dates and collection periods.

``now`` never appears: every moving bound is an ``as_of`` argument, so results repeat.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

from . import fixed_values as V


def parse_timestamp(text: Column, kind: str = "timestamp") -> Column:
    """ISO text to a timestamp; null where it cannot be read."""
    return text.try_cast(kind)


def event_year(moment: Column) -> Column:
    return F.year(moment).cast("bigint")


def event_day(moment: Column) -> Column:
    return F.to_date(moment)


def day_suffix(moment: Column) -> Column:
    """``yyyyMMdd``, the value of the archive's day partitions."""
    return F.date_format(moment, "yyyyMMdd")


def next_month_first(day: Column) -> Column:
    return F.trunc(F.add_months(day, 1), "month").cast("date")


def month_of(period: str) -> tuple[date, date] | None:
    """``YYYY-MM`` -> [first day, first day of the next month]; None for any other text."""
    try:
        first = datetime.strptime(period, "%Y-%m").date()
    except ValueError:
        return None
    return first, (first + timedelta(days=31)).replace(day=1)


def preset_range(
    preset: str, as_of: datetime, start: str | None = None, end: str | None = None
) -> tuple[datetime, datetime]:
    """The named look-back window ending at ``as_of``, or the two given days."""
    if preset == "custom":
        return datetime.fromisoformat(start), datetime.fromisoformat(end)
    days = {"week": 7, "month": 30, "year": 365}[preset]
    return as_of - timedelta(days=days), as_of


def month_third(day: Column) -> Column:
    """The third of its month a date lies in, as struct (period, first_day, end_day).

    Thirds start on the 1st, 11th and 21st; ``end_day`` is the day after the last one.
    """
    number = F.dayofmonth(day)
    month_start = F.trunc(day, "month").cast("date")
    start = F.when(number <= 10, 1).when(number <= 20, 11).otherwise(21)
    last = F.when(number <= 10, 10).when(number <= 20, 20).otherwise(F.dayofmonth(F.last_day(day)))
    return F.struct(
        F.concat(
            F.date_format(day, "yyyy-MM-"),
            F.lpad(start.cast("string"), 2, "0"),
            F.lit("-"),
            F.lpad(last.cast("string"), 2, "0"),
        ).alias("period"),
        F.date_add(month_start, start - 1).alias("first_day"),
        F.date_add(month_start, last).alias("end_day"),
    )


def adaptive_step(start: date, end: date) -> int:
    """Days per period: coarser for longer ranges."""
    span = (end - start).days
    return 10 if span > 365 else 5 if span > 90 else 2 if span > 30 else 1


def adaptive_period(day: Column, start: date, end: date) -> Column:
    """Struct (period_no, period_start, period_end) of the step a date falls into; the last
    period is clipped at ``end``. Null outside [start, end]."""
    step = adaptive_step(start, end)
    first, final = F.lit(start), F.lit(end)
    last_no = max((end - start).days - 1, 0) // step
    number = F.least(F.floor(F.datediff(day, first) / step), F.lit(last_no)).cast("int")
    begin = F.date_add(first, number * step)
    period = F.struct(
        number.alias("period_no"),
        begin.alias("period_start"),
        F.least(F.date_add(begin, step), final).alias("period_end"),
    )
    return F.when(day.between(first, final), period)


def star_range(stars: Column, ranges=V.STAR_RANGES) -> Column:
    """Position of the first range holding the value; a shared bound counts to the lower one."""
    chain = None
    for position, (low, high) in enumerate(ranges):
        inside = stars >= low if high is None else stars.between(low, high)
        chain = F.when(inside, position) if chain is None else chain.when(inside, position)
    return chain


def age_period(day: Column, as_of: date, periods=V.AGE_PERIODS) -> Column:
    """Position of the first age period holding the date; a shared bound counts to the younger."""
    chain = None
    for position, inside in enumerate(age_period_tests(day, as_of, periods)):
        chain = F.when(inside, position) if chain is None else chain.when(inside, position)
    return chain


def age_period_tests(day: Column, as_of: date, periods=V.AGE_PERIODS) -> list[Column]:
    """One test per age period, both ends inclusive."""
    tests = []
    for oldest, youngest in periods:
        inside = day >= F.lit(as_of - timedelta(days=oldest))
        if youngest is not None:
            inside = inside & (day <= F.lit(as_of - timedelta(days=youngest)))
        tests.append(inside)
    return tests
