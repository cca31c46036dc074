"""Trip durations, cleaning profiles and cleaning numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.contracts import (
    DROPOFF_CANDIDATES,
    DataValidationError,
    MetricsConfig,
    require_columns,
)
from tripweave.functions.numbers import above
from tripweave.functions.weeks import duration_minutes


def _as_time(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    kind = df.schema[name].dataType
    return c if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else c.cast("timestamp_ntz")


def with_duration(trips: DataFrame) -> DataFrame:
    """Add `trip_duration_minutes` unless it is there; negative durations are kept."""
    if "trip_duration_minutes" in trips.columns:
        return trips
    require_columns(trips, ["pickup_datetime"], "trips")
    dropoff = next((c for c in DROPOFF_CANDIDATES if c in trips.columns), None)
    if dropoff is None:
        raise DataValidationError("no dropoff datetime column found")
    minutes = duration_minutes(_as_time(trips, "pickup_datetime"), _as_time(trips, dropoff))
    return trips.withColumn("trip_duration_minutes", minutes)


def is_clean(trips: DataFrame, config: MetricsConfig = MetricsConfig()) -> Column:
    """The cleaning rule: distance, total and passengers above their limits."""
    require_columns(trips, ["trip_distance", "total_amount", "passenger_count"], "cleaning")
    return (
        above(trips, "trip_distance", config.min_trip_distance)
        & above(trips, "total_amount", config.min_total_amount)
        & above(trips, "passenger_count", config.min_passenger_count)
    )


def clean(trips: DataFrame, config: MetricsConfig = MetricsConfig()) -> DataFrame:
    return trips.filter(is_clean(trips, config))


def clean_strict(trips: DataFrame) -> DataFrame:
    """Documented strict profile: positive amounts, 1-6 passengers, dropoff after pickup."""
    passengers = F.col("passenger_count")
    return trips.filter(
        above(trips, "fare_amount", 0)
        & above(trips, "total_amount", 0)
        & above(trips, "trip_distance", 0)
        & (passengers >= 1)
        & (passengers <= 6)
        & (F.col("pickup_datetime") < F.col("dropoff_datetime"))
    )


def is_clean_middle(trips: DataFrame) -> Column:
    """Documented middle profile; needs `trip_duration_minutes`."""
    return (
        above(trips, "trip_distance", 0)
        & above(trips, "fare_amount", 0)
        & above(trips, "total_amount", 0)
        & above(trips, "passenger_count", 0)
        & above(trips, "trip_duration_minutes", 0)
        & F.col("pickup_datetime").isNotNull()
        & F.col("dropoff_datetime").isNotNull()
    )


def clean_middle(trips: DataFrame) -> DataFrame:
    return trips.filter(is_clean_middle(trips))


def with_removed(counts: DataFrame) -> DataFrame:
    """Add removed rows and their percentage (0 without rows) to initial and final rows."""
    initial, removed = F.col("initial_rows"), F.col("initial_rows") - F.col("final_rows")
    share = F.try_divide(removed.cast("double"), initial.cast("double")) * F.lit(100.0)
    return counts.withColumns(
        {"removed_rows": removed, "removed_pct": F.coalesce(share, F.lit(0.0))}
    )


def cleaning_metrics(
    trips: DataFrame, config: MetricsConfig = MetricsConfig(), *keys: Column
) -> DataFrame:
    """Rows before, after and removed, and the removed percentage, in one pass."""
    counts = trips.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(is_clean(trips, config)).alias("final_rows"),
    )
    return with_removed(counts)


def invalid_by_reason(trips: DataFrame) -> DataFrame:
    """(metric, before, after, removed) per reason, before and after the middle profile."""
    kept = is_clean_middle(trips)
    no_time = F.col("pickup_datetime").isNull() | F.col("dropoff_datetime").isNull()
    reasons = {
        "total_records": F.lit(True),
        "invalid_distance": ~F.coalesce(above(trips, "trip_distance", 0), F.lit(False)),
        "invalid_fare": ~F.coalesce(above(trips, "fare_amount", 0), F.lit(False)),
        "null_timestamps": no_time,
    }
    counts = trips.agg(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                F.count_if(test).alias("before"),
                F.count_if(test & kept).alias("after"),
            ).alias(name)
            for name, test in reasons.items()
        ]
    )
    return counts.select(F.inline(F.array(*[F.col(n) for n in reasons]))).withColumn(
        "removed", F.col("before") - F.col("after")
    )
