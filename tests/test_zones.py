"""Local times on the days the clocks change, against Python's own zone rules."""

from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tripweave.functions import zones
from tripweave.sources.fleets import SourceSpec, count_clock_marks

CHANGES = {
    "America/New_York": ("2024-03-10 02:00:00", "2024-11-03 01:00:00"),
    "Europe/Berlin": ("2024-03-31 02:00:00", "2024-10-27 02:00:00"),
    "Australia/Lord_Howe": ("2024-10-06 02:00:00", "2024-04-07 01:30:00"),  # half an hour
    "Asia/Kolkata": ("2024-03-10 02:00:00", "2024-11-03 01:00:00"),  # none
}


def in_utc(local, zone, fold):
    there = local.replace(tzinfo=ZoneInfo(zone), fold=fold)
    return there.astimezone(UTC).replace(tzinfo=None)


def kind_of(local, zone):
    first, last = in_utc(local, zone, 0), in_utc(local, zone, 1)
    back = first.replace(tzinfo=UTC).astimezone(ZoneInfo(zone)).replace(tzinfo=None)
    if back != local:
        return "skipped"
    return "repeated" if first != last else "regular"


@pytest.mark.parametrize("zone", sorted(CHANGES))
def test_readings_equal_the_zone_rules(spark, zone):
    locals_ = [
        at(text) + timedelta(minutes=m) for text in CHANGES[zone] for m in range(-180, 240, 10)
    ]
    rows = spark.createDataFrame([(t,) for t in [*locals_, None]], "t timestamp_ntz").select(
        "t",
        zones.clock_kind(F.col("t"), zone).alias("kind"),
        zones.first_reading(F.col("t"), zone, "UTC").alias("first"),
        zones.last_reading(F.col("t"), zone, "UTC").alias("last"),
    )
    found = {r["t"]: (r["kind"], r["first"], r["last"]) for r in rows.collect()}
    assert found.pop(None) == (None, None, None)
    for t in locals_:
        kind, first, last = found[t]
        assert kind == kind_of(t, zone), t
        assert first == in_utc(t, zone, 0), t
        assert last == in_utc(t, zone, 1 if kind == "repeated" else 0), t
    assert ("repeated" in {k for k, _, _ in found.values()}) == (zone != "Asia/Kolkata")


def test_a_dropoff_in_the_repeated_hour_follows_its_pickup(spark):
    rows = [
        (at("2024-11-03 01:50:00"), at("2024-11-03 01:10:00")),  # the hour began again
        (at("2024-11-03 01:10:00"), at("2024-11-03 01:50:00")),
        (at("2024-11-03 00:50:00"), at("2024-11-03 01:10:00")),
        (at("2024-11-03 02:10:00"), at("2024-11-03 01:10:00")),  # wrong under any reading
        (at("2024-03-10 01:50:00"), at("2024-03-10 02:10:00")),
        (at("2024-03-10 12:00:00"), None),
    ]
    raw = spark.createDataFrame(rows, "p timestamp_ntz, d timestamp_ntz")
    renames = {"p": "pickup_datetime", "d": "dropoff_datetime"}
    spec = SourceSpec("east", renames, time_zone="America/New_York", mark_clock=True)
    trips = spec.normalize(raw)
    minutes = [
        r["dropoff_datetime"] and (r["dropoff_datetime"] - r["pickup_datetime"]).total_seconds() / 60
        for r in trips.collect()
    ]
    assert minutes == [20, 40, 20, -120, 20, None]
    marks = {tuple(r) for r in count_clock_marks(trips).collect()}
    assert marks == {
        ("east", "repeated", "repeated", 2),
        ("east", "regular", "repeated", 2),
        ("east", "regular", "skipped", 1),
        ("east", "regular", None, 1),
    }
    later = SourceSpec("east", renames, time_zone="America/New_York", second_of_repeated=True)
    assert later.normalize(raw).first()["pickup_datetime"] == datetime(2024, 11, 3, 6, 50)
