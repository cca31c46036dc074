"""The metric tables and the documented queries around them.

Functions take daily or hourly facts (see `facts`), or one of the metric tables where
they say so. The metric tables themselves come unsorted, for further use; `in_order`
sorts them for output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.contracts import MEASURES, METRIC_KEYS, require_columns
from tripweave.functions.numbers import exact_sum, mean_of, round2, total_of
from tripweave.functions.weeks import date_text, week_name
from tripweave.operators.facts import added, roll_up

def day_column() -> Column:
    return date_text(F.col("pickup_date")).alias("date")


def revenue() -> Column:
    return round2(F.coalesce(total_of(F.col("total_amount_sum")), F.lit(0.0)))


def average(measure: str) -> Column:
    return mean_of(total_of(F.col(f"{measure}_sum")), F.col(f"{measure}_n"))


def _column_mean(name: str) -> Column:
    return mean_of(total_of(exact_sum(F.col(name).cast("double"))), F.count(name))


# --- metric tables ---------------------------------------------------------------


def in_order(table: DataFrame) -> DataFrame:
    """Sorted by date, type and hour, as far as the table has them."""
    keys = [c for c in METRIC_KEYS if c in table.columns]
    return table.orderBy(*keys) if keys else table


def trips_per_day(daily: DataFrame) -> DataFrame:
    return daily.select(day_column(), "taxi_type", F.col("trips").alias("total_trips"))


def revenue_per_day(daily: DataFrame) -> DataFrame:
    require_columns(daily, ["total_amount_sum"], "revenue_per_day")
    return daily.select(day_column(), "taxi_type", revenue().alias("total_revenue_per_day"))


def hourly_trips(hourly: DataFrame) -> DataFrame:
    """Trips of every hour that had any."""
    return hourly.select(
        day_column(), "taxi_type", "pickup_hour", F.col("trips").alias("trips_per_hour")
    )


def daily_averages(daily: DataFrame) -> DataFrame:
    require_columns(daily, [f"{m}_sum" for m in MEASURES], "daily_avg_metrics")
    means = [round2(average(m)).alias(f"avg_{m}") for m in MEASURES]
    return daily.select(day_column(), "taxi_type", *means)


# --- counts and totals -----------------------------------------------------------


def row_count(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count(F.lit(1)).alias("rows"))


def count_by_type(trips: DataFrame) -> DataFrame:
    return trips.groupBy("taxi_type").agg(F.count(F.lit(1)).alias("trip_count"))


def count_by_day(trips: DataFrame) -> DataFrame:
    return (
        trips.groupBy(F.to_date("pickup_datetime").alias("d"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .select(date_text(F.col("d")).alias("date"), "trips")
        .orderBy("date")
    )


def count_by_day_and_type(trips: DataFrame) -> DataFrame:
    return (
        trips.groupBy(F.to_date("pickup_datetime").alias("d"), "taxi_type")
        .agg(F.count(F.lit(1)).alias("trips"))
        .select(date_text(F.col("d")).alias("date"), "taxi_type", "trips")
        .orderBy("date", "taxi_type")
    )


def count_by_week(trips: DataFrame) -> DataFrame:
    """Trips per week name. Counting by day first keeps name building off the rows."""
    by_day = trips.groupBy(F.to_date("pickup_datetime").alias("d")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        by_day.filter(F.col("d").isNotNull())
        .groupBy(week_name(F.col("d")).alias("week_name"))
        .agg(F.sum("n").alias("total_trips"))
        .orderBy("week_name")
    )


def compare_weeks(weeks: dict[str, DataFrame]) -> DataFrame:
    """(week, total_trips) of separately stored weeks, one row each."""
    counts = [
        trips.agg(F.count(F.lit(1)).alias("total_trips")).select(
            F.lit(label).alias("week"), "total_trips"
        )
        for label, trips in weeks.items()
    ]
    stacked = counts[0]
    for other in counts[1:]:
        stacked = stacked.unionByName(other)
    return stacked


def weekly_by_type(daily: DataFrame) -> DataFrame:
    """Per week and type: trips, revenue, revenue per trip and share of the week's trips."""
    weekly = roll_up(
        daily.withColumn("week_name", week_name(F.col("pickup_date"))), "week_name", "taxi_type"
    )
    in_week = F.sum("trips").over(Window.partitionBy("week_name"))
    return weekly.select(
        "week_name",
        "taxi_type",
        F.col("trips").alias("total_trips"),
        revenue().alias("total_revenue"),
        round2(mean_of(total_of(F.col("total_amount_sum")), F.col("trips"))).alias("avg_revenue_per_trip"),
        round2(F.col("trips") / in_week * F.lit(100.0)).alias("share_pct"),
    ).orderBy("week_name", "taxi_type")


def executive_summary(daily: DataFrame) -> DataFrame:
    """Trips, revenue, average distance and fare per type, and over all types."""
    by_type = roll_up(daily, "taxi_type")
    label = F.when(F.grouping("taxi_type") == 1, F.lit("Total")).otherwise(F.col("taxi_type"))
    with_total = by_type.rollup("taxi_type").agg(
        label.alias("label"), *added(by_type)
    )
    return with_total.select(
        F.col("label").alias("taxi_type"),
        F.col("trips").alias("total_trips"),
        revenue().alias("total_revenue"),
        round2(average("trip_distance")).alias("avg_trip_distance"),
        round2(average("fare_amount")).alias("avg_fare_amount"),
    )


# --- from metric tables ----------------------------------------------------------


def type_ratios(averages: DataFrame) -> DataFrame:
    """Speed, fare per mile and markup per type, from the mean of its daily averages."""
    means = averages.groupBy("taxi_type").agg(
        _column_mean("avg_trip_distance").alias("distance"),
        _column_mean("avg_fare_amount").alias("fare"),
        _column_mean("avg_total_amount").alias("total"),
        _column_mean("avg_trip_duration_minutes").alias("minutes"),
    )
    distance, fare, total = F.col("distance"), F.col("fare"), F.col("total")
    hours = F.col("minutes") / F.lit(60.0)
    markup = (F.try_divide(total, fare) - F.lit(1.0)) * F.lit(100.0)
    return means.select(
        "taxi_type",
        round2(distance).alias("avg_trip_distance"),
        round2(fare).alias("avg_fare_amount"),
        round2(total).alias("avg_total_amount"),
        round2(F.try_divide(distance, hours)).alias("speed_mph"),
        round2(F.try_divide(fare, distance)).alias("fare_per_mile"),
        round2(markup).alias("markup_pct"),
    )


def weekday_weekend(daily: DataFrame) -> DataFrame:
    """Average trips and revenue of a weekday and of a weekend day."""
    by_date = roll_up(daily, "pickup_date").select(
        F.when(F.weekday("pickup_date") >= 5, F.lit("weekend"))
        .otherwise(F.lit("weekday"))
        .alias("day_kind"),
        "trips",
        revenue().alias("revenue"),
    )
    return by_date.groupBy("day_kind").agg(
        F.count(F.lit(1)).alias("num_days"),
        round2(_column_mean("trips")).alias("avg_daily_trips"),
        round2(_column_mean("revenue")).alias("avg_daily_revenue"),
    )


def peak_hours(hourly: DataFrame) -> DataFrame:
    """The busiest hour of each day and type; the earlier hour wins a tie."""
    rank = F.struct(-F.col("trips"), F.col("pickup_hour"))
    return (
        hourly.groupBy("pickup_date", "taxi_type")
        .agg(
            F.min_by("pickup_hour", rank).alias("peak_hour"),
            F.max("trips").alias("peak_trips"),
        )
        .select(day_column(), "taxi_type", "peak_hour", "peak_trips")
        .orderBy("date", "taxi_type")
    )


def hour_heatmap(hourly: DataFrame) -> DataFrame:
    """Days by hours: columns h00..h23 hold trips over all types, NULL where none."""
    cells = roll_up(hourly, "pickup_date", "pickup_hour")
    hours = list(range(24))
    matrix = cells.groupBy("pickup_date").pivot("pickup_hour", hours).agg(F.sum("trips"))
    named = [F.col(str(h)).alias(f"h{h:02d}") for h in hours]
    return matrix.select(day_column(), *named).orderBy("date")
