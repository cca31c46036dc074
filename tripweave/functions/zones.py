"""Local clock times on the days the clocks change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REGULAR, REPEATED, SKIPPED = "regular", "repeated", "skipped"
_UTC = "UTC"


def _moved(at: Column, source: str, target: str) -> Column:
    return F.convert_timezone(F.lit(source), F.lit(target), at)


def _by_offset_of(local: Column, zone: str, days: int) -> Column:
    """The local time in UTC, by the offset that the zone has some days from then."""
    near = local + F.make_dt_interval(F.lit(days))
    return local - (_moved(near, _UTC, zone) - near)


def clock_kind(local: Column, zone: str) -> Column:
    """Whether a zone's clocks show a local time once, twice ('repeated') or never ('skipped').

    The time is read with the offsets of the day before and the day after; only readings
    that lead back to it by the zone's own rules are real. NULL stays NULL.
    """
    before, after = _by_offset_of(local, zone, -1), _by_offset_of(local, zone, 1)
    real = [_moved(utc, _UTC, zone) == local for utc in (before, after)]
    return (
        F.when(local.isNull(), F.lit(None).cast("string"))
        .when(real[0] & real[1] & (before != after), F.lit(REPEATED))
        .when(~real[0] & ~real[1], F.lit(SKIPPED))
        .otherwise(F.lit(REGULAR))
    )


def first_reading(local: Column, zone: str, target: str) -> Column:
    """A local time in another zone.

    A repeated time is its first occurrence; a skipped one is moved on by the length of
    the gap, as clocks that were not set forward would show it.
    """
    return _moved(local, zone, target)


def last_reading(local: Column, zone: str, target: str) -> Column:
    """As `first_reading`, but a repeated time is its second occurrence."""
    second = F.greatest(_by_offset_of(local, zone, -1), _by_offset_of(local, zone, 1))
    twice = clock_kind(local, zone) == REPEATED
    return F.when(twice, _moved(second, _UTC, target)).otherwise(first_reading(local, zone, target))


def reading_after(start: Column, local: Column, zone: str, target: str) -> Column:
    """The first reading of a local time, or the last where only that is not before a start."""
    first, last = first_reading(local, zone, target), last_reading(local, zone, target)
    return F.when((first < start) & (last >= start), last).otherwise(first)
