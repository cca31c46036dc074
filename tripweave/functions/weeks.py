"""Dates, durations and week-of-month names."""

from __future__ import annotations

import calendar
import re
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.contracts import UNKNOWN_WEEK_PARTS, WEEK_PATTERN
from tripweave.functions.numbers import round2

_MONTHS = [m.lower() for m in calendar.month_name[1:]]


def parse_day(text: str) -> date:
    """`YYYY-MM-DD` as a date; any other text raises ValueError."""
    return datetime.strptime(text, "%Y-%m-%d").date()


def date_text(d: Column) -> Column:
    """A date (or the date of a timestamp) as `YYYY-MM-DD`."""
    return d.cast("date").cast("string")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two timestamps, exact to the microsecond.

    The difference of local timestamps is an interval, so no session zone comes in. It is
    taken apart into whole seconds and the microseconds left over, both plain integers:
    a decimal would be simpler to read and a quarter slower.
    """
    gap = end - start
    seconds = gap.cast("interval second").cast("bigint")
    left_over = gap - F.lit(timedelta(seconds=1)) * seconds
    micros = (left_over * F.lit(1_000_000)).cast("interval second").cast("bigint")
    return (seconds * F.lit(1_000_000) + micros) / F.lit(1_000_000.0)


def duration_minutes(start: Column, end: Column) -> Column:
    return round2(elapsed_seconds(start, end) / F.lit(60.0))


def week_of_month(d: Column) -> Column:
    """1 for days 1-7, 2 for days 8-14, ... 5 for days 29-31."""
    return F.ceil(F.dayofmonth(d) / F.lit(7)).cast("int")


def _month_names() -> Column:
    return F.array(*[F.lit(m) for m in _MONTHS])


def week_name(d: Column) -> Column:
    """`week_{n}_{month}_{year}` of a date; NULL without one.

    Building text costs more than most other work on a row: name days, not trips.
    """
    return F.concat(
        F.lit("week_"),
        week_of_month(d).cast("string"),
        F.lit("_"),
        F.element_at(_month_names(), F.month(d)),
        F.lit("_"),
        F.year(d).cast("string"),
    )


def week_name_of(d: date) -> str:
    """`week_name` of one date on the driver, for names of folders and tables."""
    return f"week_{(d.day - 1) // 7 + 1}_{_MONTHS[d.month - 1]}_{d.year}"


def week_file_prefix(week: Column) -> Column:
    """`week_1_september_2025` -> `2025_09_week1`.

    Names of another form only get their underscores replaced; a name of this form
    with an unknown month is an error.
    """
    month = F.array_position(_month_names(), F.lower(F.regexp_extract(week, WEEK_PATTERN, 2)))
    prefix = F.concat(
        F.regexp_extract(week, WEEK_PATTERN, 3),
        F.lit("_"),
        F.lpad(month.cast("string"), 2, "0"),
        F.lit("_week"),
        F.regexp_extract(week, WEEK_PATTERN, 1),
    )
    unknown = F.raise_error(F.concat(F.lit("unknown month in week name "), week))
    return (
        F.when(~F.rlike(week, F.lit(WEEK_PATTERN)), F.translate(week, "_", "-"))
        .when(month > 0, prefix)
        .otherwise(unknown)
    )


def file_prefix(week: str) -> str:
    """`week_file_prefix` for one name on the driver, for building paths."""
    found = re.match(WEEK_PATTERN, week)
    if found is None:
        return week.replace("_", "-")
    number, month, year = found.groups()
    if month.lower() not in _MONTHS:
        raise ValueError(f"unknown month in week name {week}")
    return f"{year}_{_MONTHS.index(month.lower()) + 1:02d}_week{number}"


def metric_file_name(slug: str, week: str = "") -> str:
    return f"{file_prefix(week)}_{slug}.csv" if week else f"{slug}.csv"


def week_range(week: str) -> tuple[date, date]:
    """First day and day after the last one of a week name, for partition pruning."""
    found = re.fullmatch(r"week_([1-5])_([a-z]+)_(\d{4})", week.lower())
    if found is None or found.group(2) not in _MONTHS:
        raise ValueError(f"not a week name: {week}")
    number, month, year = int(found[1]), _MONTHS.index(found[2]) + 1, int(found[3])
    month_start = date(year, month, 1)
    month_end = month_start + timedelta(days=calendar.monthrange(year, month)[1])
    start = month_start + timedelta(days=7 * (number - 1))
    return start, min(start + timedelta(days=7), month_end)


def week_parts(week: Column) -> tuple[Column, Column, Column]:
    """(number, Month, year) texts of a week name, or (`?`, `Unknown`, `?`)."""
    parts = F.split(week, "_")
    fits = (F.size(parts) >= 4) & (F.get(parts, F.lit(0)) == "week")
    month = F.get(parts, F.lit(2))
    capital = F.concat(F.upper(F.substring(month, 1, 1)), F.lower(F.substr(month, F.lit(2))))
    found = (F.get(parts, F.lit(1)), capital, F.get(parts, F.lit(3)))
    number, name, year = (
        F.when(fits, part).otherwise(F.lit(unknown))
        for part, unknown in zip(found, UNKNOWN_WEEK_PARTS, strict=True)
    )
    return number, name, year
