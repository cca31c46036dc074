"""Every query over the test tables, by name. Each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.contracts import GREEN_RENAMES, METRIC_NAMES, YELLOW_RENAMES, MetricsConfig
from tripweave.functions.numbers import format_count, format_money
from tripweave.functions.weeks import (
    date_text,
    week_file_prefix,
    week_name,
    week_of_month,
    week_parts,
)
from tripweave.operators import anomaly, cleaning, days, facts, metrics, quality, report, sinks
from tripweave.operators.days import trips_on
from tripweave.plans.history import open_history, update_history
from tripweave.plans.metrics_job import prepare, run_all_weeks, run_week
from tripweave.plans.report_job import report_all_weeks, report_week
from tripweave.plans.storage import (
    process_daily_range,
    process_weekly,
    store_day,
    store_range,
)
from tripweave.session import shared_dir
from tripweave.sources.fleets import (
    GREEN,
    YELLOW,
    SchemaVersion,
    SourceSpec,
    combine,
    pickup_only,
    read_versions,
)
from tripweave.sources.folders import remove
from tripweave.sources.metric_files import read_all_weeks_metric, read_metric_csv
from tripweave.sources.sample_tables import (
    event_trips,
    events_as_trips,
    lineitem_trips,
    raw_fleets,
    table,
)
from tripweave.sources.stores import (
    first_week,
    list_weeks,
    load_days,
    load_week_table,
    load_weeks,
    stored_days,
)
from tripweave.streaming.json_lines import (
    TIMES,
    land_lines,
    parse_lines,
    set_apart,
    stream_lines,
    stream_sound,
)
from tripweave.streaming.windows import (
    all_windows,
    stream_parquet,
    window_counts,
    write_windows,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BY_WEEK = anomaly.AnomalyRule(by_week=True)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def to_six(df: DataFrame, *names: str) -> DataFrame:
    """Round values that are reported unrounded, for a comparison by value."""
    return df.withColumns({c: F.round(c, 6) for c in names})


def cleaned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(cleaning.with_duration(event_trips(spark, sf_dir)))


def cleaned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(cleaning.with_duration(lineitem_trips(spark, sf_dir)))


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.daily_facts(cleaned_events(spark, sf_dir))


def event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.hourly_facts(cleaned_events(spark, sf_dir))


def line_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.daily_facts(cleaned_lines(spark, sf_dir))


def event_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five metric tables of the events, statistics by week, over written facts."""
    return prepare(event_trips(spark, sf_dir), by_week=True).tables


# --- the five metric tables ------------------------------------------------------


@query
def trips_per_day(spark, sf_dir):
    return metrics.in_order(metrics.trips_per_day(event_days(spark, sf_dir)))


@query
def trips_per_day_lines(spark, sf_dir):
    return metrics.in_order(metrics.trips_per_day(line_days(spark, sf_dir)))


@query
def revenue_per_day(spark, sf_dir):
    return metrics.in_order(metrics.revenue_per_day(event_days(spark, sf_dir)))


@query
def revenue_per_day_lines(spark, sf_dir):
    return metrics.in_order(metrics.revenue_per_day(line_days(spark, sf_dir)))


@query
def hourly_trips(spark, sf_dir):
    return metrics.in_order(metrics.hourly_trips(event_hours(spark, sf_dir)))


@query
def hourly_trips_lines(spark, sf_dir):
    hours = facts.hourly_facts(cleaned_lines(spark, sf_dir))
    return metrics.in_order(metrics.hourly_trips(hours))


@query
def daily_avg_metrics(spark, sf_dir):
    return metrics.in_order(metrics.daily_averages(event_days(spark, sf_dir)))


@query
def daily_avg_metrics_lines(spark, sf_dir):
    return metrics.in_order(metrics.daily_averages(line_days(spark, sf_dir)))


@query
def anomaly_monitoring(spark, sf_dir):
    flagged = anomaly.anomaly_monitoring(event_days(spark, sf_dir))
    return metrics.in_order(to_six(flagged, "avg_trips", "stddev_trips"))


@query
def anomaly_monitoring_lines(spark, sf_dir):
    flagged = anomaly.anomaly_monitoring(line_days(spark, sf_dir))
    return metrics.in_order(to_six(flagged, "avg_trips", "stddev_trips"))


@query
def anomaly_by_week(spark, sf_dir):
    flagged = anomaly.anomaly_monitoring(event_days(spark, sf_dir), BY_WEEK)
    return metrics.in_order(to_six(flagged, "avg_trips", "stddev_trips"))


@query
def anomaly_doc_variant(spark, sf_dir):
    flagged = anomaly.anomaly_monitoring(event_days(spark, sf_dir), anomaly.DOCUMENTED_RULE)
    return metrics.in_order(to_six(flagged, "avg_trips", "stddev_trips"))


@query
def anomaly_details(spark, sf_dir):
    return anomaly.anomaly_details(event_days(spark, sf_dir))


@query
def peak_hour_per_day(spark, sf_dir):
    return metrics.peak_hours(event_hours(spark, sf_dir))


@query
def hour_heatmap(spark, sf_dir):
    return metrics.hour_heatmap(event_hours(spark, sf_dir))


@query
def enabled_metrics(spark, sf_dir):
    """A run with two metrics switched on, stacked as (metric, date, taxi_type, amount)."""
    config = MetricsConfig(enabled=("trips_per_day", "revenue_per_day"))
    tables = prepare(event_trips(spark, sf_dir), config).tables
    stacked = [
        df.select(
            F.lit(METRIC_NAMES[slug]).alias("metric"),
            "date",
            "taxi_type",
            F.col(df.columns[-1]).cast("double").alias("amount"),
        )
        for slug, df in tables.items()
    ]
    return stacked[0].unionByName(stacked[1])


# --- cleaning and quality --------------------------------------------------------


@query
def metric_preview(spark, sf_dir):
    """The first ten rows of a metric table, as shown when it is saved."""
    return metrics.in_order(metrics.trips_per_day(event_days(spark, sf_dir))).limit(10)


@query
def cleaned_trips(spark, sf_dir):
    return cleaned_events(spark, sf_dir)


@query
def cleaned_trips_strict(spark, sf_dir):
    """The strict profile on order lines, where half of the dropoffs precede the pickup."""
    kept = cleaning.clean_strict(lineitem_trips(spark, sf_dir))
    return metrics.count_by_type(kept)


@query
def cleaned_trips_middle(spark, sf_dir):
    timed = cleaning.with_duration(lineitem_trips(spark, sf_dir))
    return metrics.count_by_type(cleaning.clean_middle(timed))


CLEANED_COLUMNS = ("VendorID", "pickup_datetime", "passenger_count", "trip_distance", "taxi_type")


@query
def strict_trips(spark, sf_dir):
    """The rows that the strict profile keeps."""
    return cleaning.clean_strict(lineitem_trips(spark, sf_dir)).select(*CLEANED_COLUMNS)


@query
def middle_trips(spark, sf_dir):
    """The rows that the middle profile keeps."""
    timed = cleaning.with_duration(lineitem_trips(spark, sf_dir))
    return cleaning.clean_middle(timed).select(*CLEANED_COLUMNS)


@query
def cleaning_metrics(spark, sf_dir):
    return to_six(cleaning.cleaning_metrics(event_trips(spark, sf_dir)), "removed_pct")


@query
def cleaning_from_job(spark, sf_dir):
    """The same numbers out of the facts that the metrics job writes."""
    return to_six(prepare(event_trips(spark, sf_dir)).cleaning(), "removed_pct")


@query
def cleaning_by_week(spark, sf_dir):
    return to_six(prepare(event_trips(spark, sf_dir)).cleaning_by_week(), "removed_pct")


@query
def invalid_by_reason(spark, sf_dir):
    return cleaning.invalid_by_reason(cleaning.with_duration(event_trips(spark, sf_dir)))


@query
def trip_durations(spark, sf_dir):
    return cleaning.with_duration(lineitem_trips(spark, sf_dir)).select(
        "VendorID", "passenger_count", "trip_duration_minutes"
    )


@query
def null_counts(spark, sf_dir):
    return quality.null_counts(event_trips(spark, sf_dir))


@query
def numeric_summary(spark, sf_dir):
    summary = quality.numeric_summary(cleaned_events(spark, sf_dir).drop("VendorID"))
    return to_six(summary, "mean", "stddev", "min", "q25", "q50", "q75", "max")


@query
def pickup_range(spark, sf_dir):
    return quality.pickup_range(event_trips(spark, sf_dir))


@query
def schema_listing(spark, sf_dir):
    return quality.schema_listing(event_trips(spark, sf_dir))


@query
def preview_green(spark, sf_dir):
    green = raw_fleets(spark, sf_dir)[0].orderBy("lpep_pickup_datetime", "VendorID")
    return quality.preview(green, GREEN_RENAMES)


@query
def preview_yellow(spark, sf_dir):
    yellow = raw_fleets(spark, sf_dir)[1].orderBy("tpep_pickup_datetime", "VendorID")
    return quality.preview(yellow, YELLOW_RENAMES)


@query
def summary_sample(spark, sf_dir):
    in_order = event_trips(spark, sf_dir).orderBy("pickup_datetime", "total_amount")
    return quality.summary_sample(in_order)


# --- sources ---------------------------------------------------------------------


@query
def normalized_union(spark, sf_dir):
    green, yellow = raw_fleets(spark, sf_dir)
    return combine([GREEN.normalize(green), YELLOW.normalize(yellow)])


@query
def pickup_only_union(spark, sf_dir):
    """The variant that renames pickup times only, so dropoff times are not common."""
    green, yellow = raw_fleets(spark, sf_dir)
    return combine([pickup_only(GREEN).normalize(green), pickup_only(YELLOW).normalize(yellow)])


@query
def multi_city_union(spark, sf_dir):
    """Two cities with local clocks, brought to UTC and counted by day."""
    green, yellow = raw_fleets(spark, sf_dir)
    east = SourceSpec("east", GREEN_RENAMES, time_zone="America/New_York")
    west = SourceSpec("west", YELLOW_RENAMES, time_zone="America/Chicago")
    return metrics.count_by_day_and_type(combine([east.normalize(green), west.normalize(yellow)]))


@query
def clock_changes(spark, sf_dir):
    """Trips of two days on which the clocks of a city change, moved to UTC and marked."""
    green, _ = raw_fleets(spark, sf_dir)
    moved = [
        green.withColumns({c: F.col(c) + F.make_dt_interval(F.lit(d)) for c in GREEN_RENAMES})
        for d in (60, 298)  # January 10th to March 10th and to November 3rd
    ]
    east = SourceSpec("east", GREEN_RENAMES, time_zone="America/New_York", mark_clock=True)
    trips = east.normalize(moved[0].unionByName(moved[1]))
    return (
        trips.withColumn("date", date_text(F.col("pickup_datetime")))
        .groupBy("date", "pickup_clock", "dropoff_clock")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.min("pickup_datetime").alias("first_pickup"),
            F.max("dropoff_datetime").alias("last_dropoff"),
        )
    )


@query
def schema_versions(spark, sf_dir):
    """Files of two schema versions read back as one table, counted by day."""
    trips = event_trips(spark, sf_dir).select("VendorID", "pickup_datetime", "total_amount")
    new = trips.withColumn("congestion_surcharge", F.col("total_amount") * F.lit(0.1))
    split = F.lit("2024-01-16").cast("timestamp_ntz")
    root = shared_dir(spark, "versions")
    files = {f"{root}/old": "2024-01-01", f"{root}/new": "2024-01-16"}
    trips.filter(F.col("pickup_datetime") < split).write.parquet(f"{root}/old")
    new.filter(F.col("pickup_datetime") >= split).write.parquet(f"{root}/new")
    versions = [SchemaVersion(trips.schema, "2024-01-16"), SchemaVersion(new.schema)]
    return (
        read_versions(spark, files, versions)
        .groupBy(date_text(F.col("pickup_datetime")).alias("date"))
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.count("congestion_surcharge").alias("with_surcharge"),
        )
    )


# --- days and weeks --------------------------------------------------------------


@query
def trips_on_date(spark, sf_dir):
    return days.trips_on(event_trips(spark, sf_dir), "2024-01-10")


@query
def sample_of_date(spark, sf_dir):
    """Ten trips of one day, in a fixed order."""
    day = days.trips_on(event_trips(spark, sf_dir), "2024-01-10")
    return day.orderBy("pickup_datetime", "VendorID").limit(10)


@query
def iso_week_trips(spark, sf_dir):
    return days.trips_in_iso_week(event_trips(spark, sf_dir), 2024, 2)


@query
def date_range_status(spark, sf_dir):
    """Ten days from the last but two on, so that some have no trips."""
    return days.range_status(event_trips(spark, sf_dir), "2024-01-28", 10)


@query
def date_range_totals(spark, sf_dir):
    return days.range_totals(days.range_status(event_trips(spark, sf_dir), "2024-01-28", 10))


@query
def week_assignment(spark, sf_dir):
    day = F.to_date("pickup_datetime")
    return (
        event_trips(spark, sf_dir)
        .groupBy(day.alias("d"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .select(
            date_text(F.col("d")).alias("date"),
            week_of_month(F.col("d")).alias("week_of_month"),
            week_name(F.col("d")).alias("week_name"),
            "trips",
        )
    )


@query
def week_list(spark, sf_dir):
    return list_weeks(lineitem_trips(spark, sf_dir))


@query
def week_file_prefixes(spark, sf_dir):
    weeks = list_weeks(lineitem_trips(spark, sf_dir))
    return weeks.select("week_name", week_file_prefix(F.col("week_name")).alias("file_prefix"))


@query
def week_name_parts(spark, sf_dir):
    weeks = list_weeks(lineitem_trips(spark, sf_dir))
    number, month, year = week_parts(F.col("week_name"))
    return weeks.select(
        "week_name", number.alias("week_num"), month.alias("month"), year.alias("year")
    )


@query
def week_over_week(spark, sf_dir):
    return metrics.count_by_week(event_trips(spark, sf_dir))


@query
def compare_weeks(spark, sf_dir):
    trips = event_trips(spark, sf_dir)
    return metrics.compare_weeks(
        {
            "Week 1": days.trips_in_range(trips, "2024-01-01", 7),
            "Week 2": days.trips_in_range(trips, "2024-01-08", 7),
        }
    )


@query
def row_count(spark, sf_dir):
    return metrics.row_count(event_trips(spark, sf_dir))


@query
def count_by_type(spark, sf_dir):
    return metrics.count_by_type(event_trips(spark, sf_dir))


@query
def count_by_day(spark, sf_dir):
    return metrics.count_by_day(event_trips(spark, sf_dir))


@query
def count_by_day_and_type(spark, sf_dir):
    return metrics.count_by_day_and_type(event_trips(spark, sf_dir))


@query
def weekly_by_type(spark, sf_dir):
    return metrics.weekly_by_type(event_days(spark, sf_dir))


@query
def type_ratios(spark, sf_dir):
    return metrics.type_ratios(metrics.daily_averages(event_days(spark, sf_dir)))


@query
def weekday_weekend(spark, sf_dir):
    return metrics.weekday_weekend(event_days(spark, sf_dir))


@query
def executive_summary(spark, sf_dir):
    return metrics.executive_summary(event_days(spark, sf_dir))


@query
def executive_summary_lines(spark, sf_dir):
    return metrics.executive_summary(line_days(spark, sf_dir))


# --- report ----------------------------------------------------------------------


@query
def weekly_totals(spark, sf_dir):
    tables = event_tables(spark, sf_dir)
    totals = report.weekly_totals(tables["trips_per_day"], tables["revenue_per_day"])
    return to_six(totals, "total_revenue", "daily_avg_trips", "daily_avg_revenue")


KPI_DOUBLES = (
    "total_revenue",
    "daily_avg_trips",
    "daily_avg_revenue",
    "avg_rev_trip",
    "best_day_revenue",
    "worst_day_revenue",
)


@query
def weekly_kpis(spark, sf_dir):
    return to_six(report.weekly_kpis(event_tables(spark, sf_dir)), *KPI_DOUBLES)


@query
def report_totals_text(spark, sf_dir):
    """Totals as the report prints them."""
    tables = event_tables(spark, sf_dir)
    totals = report.weekly_totals(tables["trips_per_day"], tables["revenue_per_day"])
    return totals.select(
        "week_name",
        format_count(F.col("total_trips")).alias("total_trips"),
        format_money(F.round("total_revenue", 6)).alias("total_revenue"),
        format_count(F.col("daily_avg_trips")).alias("daily_avg_trips"),
    )


@query
def daily_breakdown(spark, sf_dir):
    """All days with trips and their revenue."""
    tables = event_tables(spark, sf_dir)
    days = report.daily_breakdown(tables["trips_per_day"], tables["revenue_per_day"])
    return to_six(days, "revenue")


@query
def trips_by_hour(spark, sf_dir):
    return report.trips_by_hour(metrics.hourly_trips(event_hours(spark, sf_dir)))


@query
def top_hours(spark, sf_dir):
    return report.top_hours(metrics.hourly_trips(event_hours(spark, sf_dir)))


@query
def ranked_hours(spark, sf_dir):
    return report.ranked_hours(metrics.hourly_trips(event_hours(spark, sf_dir)), k=5)


@query
def best_worst_day(spark, sf_dir):
    revenue = metrics.revenue_per_day(event_days(spark, sf_dir))
    return to_six(report.best_worst_day(revenue), "best_day_revenue", "worst_day_revenue")


@query
def anomaly_count(spark, sf_dir):
    flagged = anomaly.anomaly_monitoring(event_days(spark, sf_dir), BY_WEEK)
    return report.anomaly_count(flagged)


@query
def weekly_alerts(spark, sf_dir):
    run = prepare(event_trips(spark, sf_dir), by_week=True)
    alerts = report.weekly_alerts(run.cleaning_by_week(), run.tables["anomaly_monitoring"])
    return to_six(alerts, "valid_pct")


def whole_range(trips: DataFrame) -> tuple[str, int]:
    """First day and number of days of the trips, which must have a pickup time."""
    day = F.to_date("pickup_datetime")
    first, last = trips.agg(F.min(day), F.max(day)).first()
    return first.isoformat(), (last - first).days + 1


# --- stores and files ------------------------------------------------------------


@query
def daily_store_roundtrip(spark, sf_dir):
    """All days stored, one of them stored again, then counted from the store."""
    trips, store = event_trips(spark, sf_dir), shared_dir(spark, "daily")
    start, num_days = whole_range(trips)
    store_range(trips, start, store, num_days)
    store_day(trips, start, store)
    return (
        load_days(spark, store)
        .groupBy(date_text(F.col("pickup_date")).alias("date"))
        .agg(F.count(F.lit(1)).alias("trips"), F.count("passenger_count").alias("passengers_known"))
    )


@query
def raw_days_roundtrip(spark, sf_dir):
    """Raw files of two fleets, whose schemas change on the way, stored by day and counted."""
    root, store = shared_dir(spark, "raw"), shared_dir(spark, "daily")
    start, num_days = whole_range(event_trips(spark, sf_dir))
    until = (date.fromisoformat(start) + timedelta(days=num_days // 2)).isoformat()
    split = F.lit(f"{until} 00:00:00").cast("timestamp_ntz")
    specs = []
    for spec, raw in zip((GREEN, YELLOW), raw_fleets(spark, sf_dir), strict=True):
        pickup = F.col(next(o for o, n in spec.renames.items() if n == "pickup_datetime"))
        old = raw.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
        new = raw.withColumn("congestion_surcharge", F.col("total_amount") * F.lit(0.5))
        old.filter(pickup < split).write.parquet(f"{root}/{spec.tag}_{start}")
        new.filter(pickup >= split).write.parquet(f"{root}/{spec.tag}_{until}")
        versions = (SchemaVersion(old.schema, until), SchemaVersion(new.schema))
        specs.append(replace(spec, paths=(f"{root}/{spec.tag}_*",), versions=versions))
    process_daily_range(spark, specs, start, store, num_days)
    known = [F.count(c).alias(f"n_{c}") for c in ("passenger_count", "congestion_surcharge")]
    return (
        load_days(spark, store)
        .groupBy(date_text(F.col("pickup_date")).alias("date"), "taxi_type")
        .agg(F.count(F.lit(1)).alias("trips"), *known, F.sum("VendorID").alias("vendor_sum"))
    )


@query
def raw_unknown_versions(spark, sf_dir):
    """Raw files whose types change back and forth, loaded by what their footers say."""
    root, store = shared_dir(spark, "raw"), shared_dir(spark, "daily")
    start, num_days = whole_range(event_trips(spark, sf_dir))
    kinds = (("bigint", "int"), ("double", "bigint"), ("bigint", "bigint"))
    specs = []
    for spec, raw in zip((GREEN, YELLOW), raw_fleets(spark, sf_dir), strict=True):
        for k, (passengers, vendor) in enumerate(kinds):
            part = raw.filter(F.col("VendorID") % 3 == k).withColumns(
                {
                    "passenger_count": F.col("passenger_count").cast(passengers),
                    "VendorID": F.col("VendorID").cast(vendor),
                }
            )
            part = part.withColumn("tip_amount", F.lit(0.5)) if k == 1 else part
            part.write.parquet(f"{root}/{spec.tag}_{k}")
        specs.append(replace(spec, paths=(f"{root}/{spec.tag}_*",), widen=True))
    process_daily_range(spark, specs, start, store, num_days)
    known = [F.count(c).alias(f"n_{c}") for c in ("passenger_count", "tip_amount")]
    return (
        load_days(spark, store)
        .groupBy(date_text(F.col("pickup_date")).alias("date"), "taxi_type")
        .agg(F.count(F.lit(1)).alias("trips"), *known, F.sum("VendorID").alias("vendor_sum"))
    )


@query
def stored_day_weeks(spark, sf_dir):
    """The stored days and their weeks, listed without reading trips."""
    store = shared_dir(spark, "daily")
    sinks.save_days(event_trips(spark, sf_dir), store)
    return stored_days(spark, store).select(
        date_text(F.col("pickup_date")).alias("date"), "week_name"
    )


@query
def first_stored_week(spark, sf_dir):
    store = shared_dir(spark, "daily")
    sinks.save_days(event_trips(spark, sf_dir), store)
    return first_week(stored_days(spark, store))


@query
def weekly_store_roundtrip(spark, sf_dir):
    """Stored days published by week, and counted from the weekly store."""
    store, weekly = shared_dir(spark, "daily"), shared_dir(spark, "weekly")
    sinks.save_days(event_trips(spark, sf_dir), store)
    process_weekly(spark, store, weekly)
    return spark.read.parquet(weekly).groupBy("week_name").agg(F.count(F.lit(1)).alias("trips"))


@query
def weeks_kept_current(spark, sf_dir):
    """Published weeks after one day was stored again with fewer trips and one was removed."""
    store, weekly = shared_dir(spark, "daily"), shared_dir(spark, "weekly")
    trips = event_trips(spark, sf_dir)
    sinks.save_days(trips, store)
    process_weekly(spark, store, weekly)
    fewer = trips_on(trips, "2024-01-03").filter(F.col("VendorID") % 2 == 0)
    sinks.save_days(fewer, store, one_day=True)
    remove(spark, f"{store}/pickup_date=2024-01-20")
    process_weekly(spark, store, weekly)
    return spark.read.parquet(weekly).groupBy("week_name").agg(
        F.count(F.lit(1)).alias("trips"), F.min("VendorID").alias("first_vendor")
    )


@query
def anomaly_kept_current(spark, sf_dir):
    """The anomaly table of a history that followed its store: a day stored short at first and
    put right later, a day that came last, and one that should not be there and went again."""
    store, history = shared_dir(spark, "daily"), shared_dir(spark, "history")
    trips = event_trips(spark, sf_dir)
    day = F.to_date("pickup_datetime")
    short = (day == F.lit("2024-01-03").cast("date")) & (F.col("VendorID") % 2 == 1)
    late = day == F.lit("2024-01-20").cast("date")
    year = F.make_interval(F.lit(1))
    stray = trips.filter(late).withColumn("pickup_datetime", F.col("pickup_datetime") + year)
    sinks.save_days(trips.filter(~short & ~late).unionByName(stray), store)
    update_history(spark, store, history)
    sinks.save_days(trips_on(trips, "2024-01-03"), store, one_day=True)
    sinks.save_days(trips.filter(late), store, one_day=True)
    remove(spark, f"{store}/pickup_date=2025-01-20")
    update_history(spark, store, history)
    flagged = open_history(spark, history).anomalies()
    return metrics.in_order(to_six(flagged, "avg_trips", "stddev_trips"))


@query
def week_table_roundtrip(spark, sf_dir):
    """Stored days published as tables, the last week once more; counted by week and type."""
    store, weekly = shared_dir(spark, "daily"), shared_dir(spark, "weekly")
    sinks.save_days(event_trips(spark, sf_dir), store)
    weeks = process_weekly(spark, store, weekly, as_tables=True)
    process_weekly(spark, store, weekly, as_tables=True, weeks=weeks[-1:])
    last = load_week_table(spark, weeks[-1]).withColumn("week_name", F.lit(weeks[-1]))
    others = load_weeks(spark, weekly, weeks).filter(F.col("week_name") != weeks[-1])
    return (
        others.unionByName(last)
        .groupBy("week_name", "taxi_type")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


@query
def csv_roundtrip(spark, sf_dir):
    """The anomaly metric of all weeks, written as CSV by the job and read back."""
    out = shared_dir(spark, "metrics")
    run_all_weeks(event_trips(spark, sf_dir), out)
    return to_six(
        read_all_weeks_metric(spark, out, "anomaly_monitoring"), "avg_trips", "stddev_trips"
    )


@query
def report_from_csv(spark, sf_dir):
    """The weekly key figures, computed from the CSV files of the metrics job."""
    out = shared_dir(spark, "metrics")
    run_all_weeks(event_trips(spark, sf_dir), out)
    return to_six(report_all_weeks(spark, out).kpis, *KPI_DOUBLES)


@query
def weekly_job_reports(spark, sf_dir):
    """Every week by itself: stored, its metric files written, its report read from them."""
    store, weekly, out = (shared_dir(spark, n) for n in ("daily", "weekly", "metrics"))
    sinks.save_days(event_trips(spark, sf_dir), store)
    weeks = process_weekly(spark, store, weekly)
    kpis = []
    for week in weeks:
        run_week(spark, week, out, weekly_dir=weekly).close()
        kpis.append(report_week(spark, out, week).kpis)
    return to_six(reduce(DataFrame.unionByName, kpis), *KPI_DOUBLES)


@query
def anomaly_other_thresholds(spark, sf_dir):
    """The anomaly metric under thresholds of its own."""
    config = MetricsConfig(
        min_trip_distance=5.0,
        min_total_amount=20.0,
        min_passenger_count=1.0,
        anomaly_std_threshold=1.0,
    )
    table = prepare(event_trips(spark, sf_dir), config).tables["anomaly_monitoring"]
    return to_six(table, "avg_trips", "stddev_trips")


@query
def report_from_old_csv(spark, sf_dir):
    """Weekly totals out of CSV parts with old headers and counts written as decimals."""
    tables, out = event_tables(spark, sf_dir), shared_dir(spark, "old-csv")
    trips = tables["trips_per_day"].select(
        F.date_format(F.col("date").cast("date"), "yyyy-MM-dd HH:mm:ss").alias("pickup_date"),
        "taxi_type",
        F.concat(F.col("total_trips").cast("string"), F.lit(".0")).alias("trips_per_day"),
    )
    revenue = tables["revenue_per_day"].select(
        F.col("date").alias("pickup_date"),
        "taxi_type",
        F.col("total_revenue_per_day").cast("decimal(28,2)").cast("string").alias(
            "revenue_per_day"
        ),
    )
    paths = {"trips_per_day": trips, "revenue_per_day": revenue}
    for name, old in paths.items():
        parts = old.repartition(3, "pickup_date")
        parts.write.option("header", True).csv(f"{out}/{name}")
    totals = report.weekly_totals(
        read_metric_csv(spark, f"{out}/trips_per_day", ("date", "taxi_type", "total_trips")),
        read_metric_csv(spark, f"{out}/revenue_per_day", ("date", "taxi_type", "total_revenue")),
    )
    return to_six(totals, "total_revenue", "daily_avg_trips", "daily_avg_revenue")


@query
def stream_window_counts(spark, sf_dir):
    """Events streamed through five-minute windows, with those still open at the end."""
    schema = table(spark, sf_dir, "events").schema
    # A glob matches the table where it is one file as well as where it is a folder of files.
    stream = stream_parquet(spark, f"{sf_dir}/events.parquet*", schema)
    out, state = shared_dir(spark, "windows"), shared_dir(spark, "windows-state")
    counts = window_counts(events_as_trips(stream))
    write_windows(counts, out, state, fail_on_late=True)
    return all_windows(spark, out, state)


def event_lines(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """A folder with the events as lines of JSON, cut and doubled ones between them."""
    events, folder = table(spark, sf_dir, "events"), shared_dir(spark, "lines")
    schema = events.select("event_id", "ts", "event_type", "value").schema
    whole = F.to_json(F.struct(*schema.fieldNames()), {**TIMES, "ignoreNullFields": "false"})
    n = F.col("event_id")
    more = F.array_compact(
        F.array(
            F.col("line"),
            F.when(n % 50 == 0, F.expr("left(line, length(line) DIV 2)")),
            F.when(n % 70 == 0, F.concat("line", "line")),
            F.when(n % 90 == 0, F.lit('{"event_id":1}')),
        )
    )
    lines = events.select("event_id", whole.alias("line")).select(F.explode(more).alias("value"))
    lines.write.text(folder)
    return folder, schema


def landed_events(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    folder, schema = event_lines(spark, sf_dir)
    landed, state = shared_dir(spark, "landed"), shared_dir(spark, "landed-state")
    lines = stream_lines(spark, folder, "part-*")
    land_lines(parse_lines(lines, schema, ["ts"]), landed, state)
    return landed, schema


@query
def json_window_counts(spark, sf_dir):
    """As `stream_window_counts`, from lines of JSON with broken ones between."""
    landed, schema = landed_events(spark, sf_dir)
    out, state = shared_dir(spark, "windows"), shared_dir(spark, "windows-state")
    counts = window_counts(events_as_trips(stream_sound(spark, landed, schema)))
    write_windows(counts, out, state, fail_on_late=True)
    return all_windows(spark, out, state)


@query
def json_lines_set_apart(spark, sf_dir):
    """The lines that are no sound event, counted by what is wrong with them."""
    landed, schema = landed_events(spark, sf_dir)
    apart = set_apart(spark, landed, schema)
    return apart.groupBy("problem").agg(F.count(F.lit(1)).alias("lines"))
