from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tripweave.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
TRIP_DDL = (
    "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, passenger_count double, "
    "trip_distance double, fare_amount double, total_amount double, taxi_type string"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4,4]",  # four threads, four attempts per task
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    """Runs a test under several session zones."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def at(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def trip(
    pickup="2024-01-01 08:00:00",
    dropoff="2024-01-01 08:10:00",
    passengers=1.0,
    distance=2.0,
    fare=8.0,
    total=10.0,
    kind="Green",
):
    return (at(pickup), at(dropoff), passengers, distance, fare, total, kind)


@pytest.fixture(scope="session")
def make_trips(spark):
    return lambda rows: spark.createDataFrame(rows, TRIP_DDL)


def as_dicts(df):
    return [row.asDict() for row in df.collect()]
