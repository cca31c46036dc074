"""Weekly report tables, computed from the metric tables.

Every function takes metric tables with a `date` column. Without a week name the rows
are reported per week of their date; with one, all rows belong to that week.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.contracts import ALERT_MAX_ANOMALIES, ALERT_MIN_VALID_PCT, TOP_HOURS
from tripweave.functions.numbers import exact_sum, mean_of, total_of
from tripweave.functions.weeks import week_name as week_of
from tripweave.functions.weeks import week_parts


def revenue_column(revenue: DataFrame) -> str:
    """Current or older name of the revenue column."""
    names = ("total_revenue_per_day", "total_revenue")
    return next((c for c in names if c in revenue.columns), names[0])


def _week_of_date() -> Column:
    return week_of(F.col("date").try_cast("date"))


def _weekly(df: DataFrame, week: str | None, *aggregates: Column) -> DataFrame:
    """Aggregates per week. A named week yields a row even when it has none."""
    if week is None:
        return df.groupBy(_week_of_date().alias("week_name")).agg(*aggregates)
    return df.agg(*aggregates).select(F.lit(week).alias("week_name"), "*")


def _merge(parts: list[DataFrame]) -> DataFrame:
    """One row per week out of frames that each fill their own columns."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    columns = [c for c in stacked.columns if c != "week_name"]
    return stacked.groupBy("week_name").agg(
        *[F.any_value(c, F.lit(True)).alias(c) for c in columns]
    )


def _total(name: str) -> Column:
    return total_of(exact_sum(F.col(name).cast("double")))


def weekly_totals(trips: DataFrame, revenue: DataFrame, week: str | None = None) -> DataFrame:
    """Totals, number of days and daily averages; zeros when there are no rows."""
    money = revenue_column(revenue)
    parts = [
        _weekly(
            trips,
            week,
            F.sum("total_trips").alias("total_trips"),
            F.count_distinct("date").alias("num_days"),
        ),
        _weekly(revenue, week, _total(money).alias("total_revenue")),
    ]
    days = F.greatest(F.coalesce(F.col("num_days"), F.lit(0)), F.lit(1))
    return _merge(parts).select(
        "week_name",
        F.coalesce("total_trips", F.lit(0)).alias("total_trips"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        days.alias("num_days"),
    ).withColumns(
        {
            "daily_avg_trips": F.col("total_trips") / F.col("num_days"),
            "daily_avg_revenue": F.col("total_revenue") / F.col("num_days"),
        }
    )


def _hours_of_week(hourly: DataFrame, week: str | None) -> DataFrame:
    name = F.lit(week) if week else _week_of_date()
    return hourly.groupBy(name.alias("week_name"), "pickup_hour").agg(
        F.sum("trips_per_hour").alias("trips")
    )


def ranked_hours(hourly: DataFrame, k: int = TOP_HOURS, week: str | None = None) -> DataFrame:
    """(week_name, rank, pickup_hour, trips): the k busiest hours; earlier hours win ties."""
    order = Window.partitionBy("week_name").orderBy(F.desc("trips"), "pickup_hour")
    return (
        _hours_of_week(hourly, week)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("week_name", "rank", "pickup_hour", "trips")
    )


def top_hours(hourly: DataFrame, k: int = TOP_HOURS) -> DataFrame:
    """The k busiest hours over the whole table."""
    return (
        hourly.groupBy("pickup_hour")
        .agg(F.sum("trips_per_hour").alias("trips"))
        .orderBy(F.desc("trips"), "pickup_hour")
        .limit(k)
    )


def trips_by_hour(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy("pickup_hour")
        .agg(F.sum("trips_per_hour").alias("trips"))
        .orderBy("pickup_hour")
    )


def _busiest_text(hourly: DataFrame, week: str | None, k: int = TOP_HOURS) -> DataFrame:
    """`17:00, 18:00, 16:00`. A week has 24 hours, so the collected list is short."""
    ranked = F.array_sort(F.collect_list(F.struct(-F.col("trips"), F.col("pickup_hour"))))
    texts = F.transform(
        F.slice(ranked, 1, k), lambda h: F.concat(h["pickup_hour"].cast("string"), F.lit(":00"))
    )
    return (
        _hours_of_week(hourly, week)
        .groupBy("week_name")
        .agg(F.array_join(texts, ", ").alias("busiest_hours"))
    )


def best_worst_day(revenue: DataFrame, week: str | None = None) -> DataFrame:
    """Days of highest and lowest revenue over all types; earlier days win ties."""
    money = revenue_column(revenue)
    by_date = revenue.groupBy("date").agg(_total(money).alias("revenue"))
    down = F.struct(-F.col("revenue"), F.col("date"))
    up = F.struct(F.col("revenue"), F.col("date"))
    return _weekly(
        by_date,
        week,
        F.min_by("date", down).alias("best_day"),
        F.max("revenue").alias("best_day_revenue"),
        F.min_by("date", up).alias("worst_day"),
        F.min("revenue").alias("worst_day_revenue"),
    )


def anomaly_count(anomalies: DataFrame, week: str | None = None) -> DataFrame:
    return _weekly(anomalies, week, F.count_if("is_anomaly").alias("anomaly_count"))


def average_revenue_per_trip(averages: DataFrame, week: str | None = None) -> DataFrame:
    """Unweighted mean of the daily averages."""
    mean = mean_of(_total("avg_total_amount"), F.count("avg_total_amount"))
    return _weekly(averages, week, mean.alias("avg_rev_trip"))


def weekly_kpis(tables: Mapping[str, DataFrame], week: str | None = None) -> DataFrame:
    """The key figures of the weekly report, one row per week.

    ``tables`` holds the five metric tables by slug.
    """
    hourly, revenue = tables["peak_hour_per_day"], tables["revenue_per_day"]
    number, month, year = week_parts(F.col("week_name"))
    merged = _merge(
        [
            weekly_totals(tables["trips_per_day"], revenue, week),
            average_revenue_per_trip(tables["daily_avg_metrics"], week),
            anomaly_count(tables["anomaly_monitoring"], week),
            best_worst_day(revenue, week),
            _busiest_text(hourly, week),
        ]
    )
    zero = F.coalesce("anomaly_count", F.lit(0))
    title = F.concat(F.lit("Week "), number, F.lit(", "), month, F.lit(" "), year)
    return merged.withColumn("anomaly_count", zero).select(
        "week_name",
        title.alias("week_title"),
        "total_trips",
        "total_revenue",
        "num_days",
        "daily_avg_trips",
        "daily_avg_revenue",
        "avg_rev_trip",
        "anomaly_count",
        "best_day",
        "best_day_revenue",
        "worst_day",
        "worst_day_revenue",
        "busiest_hours",
    )


def daily_breakdown(trips: DataFrame, revenue: DataFrame) -> DataFrame:
    """(date, trips, revenue) for every date with trips; revenue 0 where there is none."""
    money = revenue_column(revenue)
    by_date = trips.groupBy("date").agg(F.sum("total_trips").alias("trips"))
    earned = revenue.groupBy("date").agg(_total(money).alias("revenue"))
    return (
        by_date.join(earned, "date", "left")
        .select("date", "trips", F.coalesce("revenue", F.lit(0.0)).alias("revenue"))
        .orderBy("date")
    )


def weekly_alerts(
    cleaning: DataFrame,
    anomalies: DataFrame,
    min_valid_pct: float = ALERT_MIN_VALID_PCT,
    max_anomalies: int = ALERT_MAX_ANOMALIES,
) -> DataFrame:
    """Per week: valid share and anomaly count, each with its alert flag.

    ``cleaning`` is `cleaning_metrics` keyed by `week_name`.
    """
    valid = F.lit(100.0) - F.col("removed_pct")
    merged = _merge(
        [cleaning.select("week_name", valid.alias("valid_pct")), anomaly_count(anomalies)]
    )
    flagged = F.coalesce("anomaly_count", F.lit(0))
    return merged.select(
        "week_name",
        "valid_pct",
        flagged.alias("anomaly_count"),
        (F.col("valid_pct") < F.lit(min_valid_pct)).alias("quality_alert"),
        (flagged > F.lit(max_anomalies)).alias("anomaly_alert"),
    ).orderBy("week_name")
