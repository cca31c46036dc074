"""Mergeable sums and counts that every metric is a projection of.

Trips are scanned and shuffled once, as partial sums by (day, type[, hour]); hourly
facts roll up to daily facts, and daily facts carry all that the metrics need. A metric
asked for alone keeps only its own columns, down to the Parquet scan.

A whole job uses audited facts: they also count the rows that cleaning drops, so that
cleaning numbers come out of the same scan. They are ordinary aggregates and not task
accumulators, and stay exact when a lost executor makes tasks run twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.contracts import MEASURES, require_columns
from tripweave.functions.numbers import add_up, exact_sum, known
from tripweave.operators.cleaning import with_removed

KEYS = ("pickup_date", "taxi_type")


def _keyed(trips: DataFrame) -> DataFrame:
    """Trips with a day and a type; rows without either belong to no group."""
    require_columns(trips, ("pickup_datetime", "taxi_type"), "trips")
    keyed = trips.filter(F.col("pickup_datetime").isNotNull() & F.col("taxi_type").isNotNull())
    return keyed.withColumn("pickup_date", F.to_date("pickup_datetime"))


def _measured(trips: DataFrame, keep: Column | None = None) -> list[Column]:
    values = {m: known(trips, m) for m in MEASURES if m in trips.columns}
    if keep is not None:
        values = {m: F.when(keep, v) for m, v in values.items()}
    sums = [exact_sum(v.cast("double")).alias(f"{m}_sum") for m, v in values.items()]
    counts = [F.count(v).alias(f"{m}_n") for m, v in values.items()]
    return [*sums, *counts]


def hourly_facts(trips: DataFrame) -> DataFrame:
    return (
        _keyed(trips)
        .groupBy(*KEYS, F.hour("pickup_datetime").alias("pickup_hour"))
        .agg(F.count(F.lit(1)).alias("trips"), *_measured(trips))
    )


def daily_facts(trips: DataFrame) -> DataFrame:
    return _keyed(trips).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("trips"), *_measured(trips))


def audited_facts(trips: DataFrame, keep: Column) -> DataFrame:
    """Hourly facts of the rows that pass `keep`, next to the count of all rows."""
    require_columns(trips, ("pickup_datetime", "taxi_type"), "trips")
    kept = F.col("_kept")
    return (
        trips.withColumn("_kept", F.coalesce(keep, F.lit(False)))
        .groupBy(
            F.to_date("pickup_datetime").alias("pickup_date"),
            "taxi_type",
            F.hour("pickup_datetime").alias("pickup_hour"),
        )
        .agg(
            F.count(F.lit(1)).alias("all_rows"),
            F.count_if(kept).alias("trips"),
            *_measured(trips, kept),
        )
    )


def kept_facts(audited: DataFrame) -> DataFrame:
    """Hourly facts out of audited ones."""
    has_keys = F.col("pickup_date").isNotNull() & F.col("taxi_type").isNotNull()
    return audited.filter(has_keys & (F.col("trips") > 0)).drop("all_rows")


def audit(audited: DataFrame, *keys: Column) -> DataFrame:
    """Cleaning numbers out of audited facts."""
    counts = audited.groupBy(*keys).agg(
        F.coalesce(F.sum("all_rows"), F.lit(0)).alias("initial_rows"),
        F.coalesce(F.sum("trips"), F.lit(0)).alias("final_rows"),
    )
    return with_removed(counts)


def added(facts: DataFrame) -> list[Column]:
    """Aggregates that add facts up; the sums are structs of their own."""
    counts = [c for c in facts.columns if c == "trips" or c.endswith("_n")]
    sums = [c for c in facts.columns if c.endswith("_sum")]
    return [F.sum(c).alias(c) for c in counts] + [add_up(F.col(c)).alias(c) for c in sums]


def roll_up(facts: DataFrame, *keys: str) -> DataFrame:
    """Facts over fewer keys."""
    return facts.groupBy(*keys).agg(*added(facts))


def daily_from_hourly(hourly: DataFrame) -> DataFrame:
    return roll_up(hourly, *KEYS)
