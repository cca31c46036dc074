"""Names, thresholds and schemas shared by every stage."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

# --- Fixed values: names and numbers that results must agree on ------------------

GREEN_RENAMES = {
    "lpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
}
YELLOW_RENAMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
}
GREEN_TAG = "Green"
YELLOW_TAG = "Yellow"

DROPOFF_CANDIDATES = ("lpep_dropoff_datetime", "dropoff_datetime")

# Types of the numeric trip columns, whatever a single file has.
TRIP_TYPES = {
    "VendorID": "bigint",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "Airport_fee": "double",
}

MEASURES = (
    "trip_distance",
    "fare_amount",
    "total_amount",
    "passenger_count",
    "trip_duration_minutes",
)

PREVIEW_MEASURES = ("passenger_count", "trip_distance", "fare_amount", "total_amount")
SUMMARY_COLUMNS = (
    "taxi_type",
    "pickup_datetime",
    "trip_distance",
    "fare_amount",
    "total_amount",
)

MIN_TRIP_DISTANCE = 0.0
MIN_TOTAL_AMOUNT = 0.0
MIN_PASSENGER_COUNT = 0
ANOMALY_STD_THRESHOLD = 1.5
ANOMALY_PCT_CHANGE_THRESHOLD = -20.0
ANOMALY_PASSENGER_LIMIT = 2.0
DOCUMENTED_STD_THRESHOLD = 2.0
ALERT_MIN_VALID_PCT = 95.0
ALERT_MAX_ANOMALIES = 3

WEEK_PATTERN = r"^week_(\d+)_(\w+)_(\d{4})"
UNKNOWN_WEEK = "weekly_taxi_data"
UNKNOWN_WEEK_PARTS = ("?", "Unknown", "?")

TOP_HOURS = 3
PREVIEW_ROWS = 5
SUMMARY_ROWS = 3
JDBC_BATCH_ROWS = 10_000
STREAM_WINDOW = "5 minutes"
STREAM_LATENESS = "10 minutes"

# Metric file slug -> display name.
METRIC_NAMES = {
    "trips_per_day": "Trips Per Day",
    "revenue_per_day": "Revenue Per Day",
    "peak_hour_per_day": "Peak Hour Per Day",
    "daily_avg_metrics": "Daily Average Metrics",
    "anomaly_monitoring": "Anomaly Monitoring",
}

# Header names found in older metric files -> current names.
DATE_ALIAS = ("pickup_date", "date")
TRIPS_ALIAS = ("trips_per_day", "total_trips")
REVENUE_ALIAS = ("revenue_per_day", "total_revenue")
AVG_REVENUE_ALIAS = ("avg_rev_per_trip", "avg_revenue_per_trip")

# Metric tables are sorted by those of these columns that they have.
METRIC_KEYS = ("date", "taxi_type", "pickup_hour")

# Columns of each metric table with their SQL types, in order.
METRIC_SCHEMAS: dict[str, dict[str, str]] = {
    "trips_per_day": {"date": "string", "taxi_type": "string", "total_trips": "bigint"},
    "revenue_per_day": {
        "date": "string",
        "taxi_type": "string",
        "total_revenue_per_day": "double",
    },
    "peak_hour_per_day": {
        "date": "string",
        "taxi_type": "string",
        "pickup_hour": "int",
        "trips_per_hour": "bigint",
    },
    "daily_avg_metrics": {
        "date": "string",
        "taxi_type": "string",
        "avg_trip_distance": "double",
        "avg_fare_amount": "double",
        "avg_total_amount": "double",
        "avg_passenger_count": "double",
        "avg_trip_duration_minutes": "double",
    },
    "anomaly_monitoring": {
        "date": "string",
        "taxi_type": "string",
        "daily_trips": "bigint",
        "total_revenue_per_day": "double",
        "avg_passenger_count": "double",
        "avg_trips": "double",
        "stddev_trips": "double",
        "pct_change_trips": "double",
        "is_anomaly": "boolean",
    },
}

REPORT_COLUMNS: dict[str, tuple[str, ...]] = {
    "trips_per_day": ("date", "total_trips"),
    "revenue_per_day": ("date", "total_revenue_per_day"),
    "peak_hour_per_day": ("date", "pickup_hour", "trips_per_hour"),
    "daily_avg_metrics": ("date", "avg_total_amount"),
    "anomaly_monitoring": ("date", "is_anomaly", "total_revenue_per_day"),
}

# --- End of fixed values ---------------------------------------------------------


class TripError(Exception):
    """Base of the errors raised by this package."""


class DataValidationError(TripError):
    """Input data is missing, empty or unreadable."""


class SchemaError(TripError, ValueError):
    """A stage did not get the columns it needs."""


class AggregationError(TripError):
    """A metric could not be computed."""


@dataclass(frozen=True)
class MetricsConfig:
    """Thresholds of the cleaning filter and of the anomaly flag.

    ``enabled`` lists the metric slugs to run, in order; None runs all of them.
    """

    min_trip_distance: float = MIN_TRIP_DISTANCE
    min_total_amount: float = MIN_TOTAL_AMOUNT
    min_passenger_count: float = MIN_PASSENGER_COUNT
    anomaly_std_threshold: float = ANOMALY_STD_THRESHOLD
    anomaly_pct_change_threshold: float = ANOMALY_PCT_CHANGE_THRESHOLD
    anomaly_passenger_limit: float = ANOMALY_PASSENGER_LIMIT
    enabled: tuple[str, ...] | None = None


def require_columns(df: DataFrame, required: Iterable[str], where: str) -> None:
    """Raise SchemaError naming the missing and the present columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaError(f"{where}: missing columns {missing}; present columns {df.columns}")
