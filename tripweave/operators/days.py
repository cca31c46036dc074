"""Picking trips by day and reporting on day ranges."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.weeks import date_text, parse_day


def between_days(start: date, end: date) -> Column:
    """Pickup on or after `start` and before `end`, as a range the Parquet reader can use.

    The bounds are written as text: a Python datetime would become a zoned timestamp and
    move with the session zone.
    """

    def midnight(day: date) -> Column:
        return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")

    pickup = F.col("pickup_datetime")
    return (pickup >= midnight(start)) & (pickup < midnight(end))


def trips_on(trips: DataFrame, day: str) -> DataFrame:
    """Trips picked up on one day; malformed text raises ValueError."""
    start = parse_day(day)
    return trips.filter(between_days(start, start + timedelta(days=1)))


def trips_in_range(trips: DataFrame, start_day: str, num_days: int = 7) -> DataFrame:
    start = parse_day(start_day)
    return trips.filter(between_days(start, start + timedelta(days=num_days)))


def trips_in_iso_week(trips: DataFrame, year: int, week: int) -> DataFrame:
    """Trips of one ISO week, as a range rather than a computed week number."""
    monday = date.fromisocalendar(year, week, 1)
    return trips.filter(between_days(monday, monday + timedelta(days=7)))


def range_status(trips: DataFrame, start_day: str, num_days: int = 7) -> DataFrame:
    """(date, trips, status) for every requested day, also those without trips.

    Reads the pickup column only.
    """
    start = parse_day(start_day)
    last = start + timedelta(days=num_days - 1)
    spark = trips.sparkSession
    wanted = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(last), F.expr("interval 1 day"))).alias("day")
    )
    counts = (
        trips_in_range(trips, start_day, num_days)
        .groupBy(F.to_date("pickup_datetime").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    found = F.coalesce(F.col("n"), F.lit(0))
    return (
        wanted.join(counts, "day", "left")
        .select(
            date_text(F.col("day")).alias("date"),
            found.alias("trips"),
            F.when(found > 0, F.lit("processed")).otherwise(F.lit("skipped")).alias("status"),
        )
        .orderBy("date")
    )


def range_totals(status: DataFrame) -> DataFrame:
    """(days_requested, days_processed, days_skipped) of a `range_status` frame."""
    done = F.col("status") == "processed"
    return status.agg(
        F.count(F.lit(1)).alias("days_requested"),
        F.count_if(done).alias("days_processed"),
        F.count_if(~done).alias("days_skipped"),
    )
