"""Storing trips by day and publishing them by week."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.weeks import parse_day, week_name, week_name_of
from tripweave.operators.days import range_status, trips_in_range, trips_on
from tripweave.operators.sinks import register_week, save_days, save_weeks, unregister_week
from tripweave.plans.published import changed_weeks, files_of_days, record, remove_weeks
from tripweave.sources.fleets import SourceSpec, load_trips
from tripweave.sources.folders import data_files, key_folders
from tripweave.sources.stores import load_days


def store_day(trips: DataFrame, day: str, daily_dir: str, rebalance: bool = True) -> None:
    """Store one day; a day without trips leaves the store as it is."""
    save_days(trips_on(trips, day), daily_dir, rebalance, one_day=True)


def store_range(
    trips: DataFrame,
    start_day: str,
    daily_dir: str,
    num_days: int = 7,
    rebalance: bool = True,
) -> DataFrame:
    """Store consecutive days in one job; returns the status of every day.

    The raw trips are scanned once: the status counts what this job has written, from the
    footers of the day folders whose files changed. Malformed start days raise ValueError
    before anything is read.
    """
    start, spark = parse_day(start_day), trips.sparkSession
    asked = [(start + timedelta(days=i)).isoformat() for i in range(num_days)]

    def stored() -> dict[str, frozenset[str]]:
        there = set(key_folders(spark, daily_dir, "pickup_date")) & set(asked)
        return {d: data_files(spark, f"{daily_dir.rstrip('/')}/pickup_date={d}") for d in there}

    before = stored()
    chosen = trips_in_range(trips, start_day, num_days)
    save_days(chosen, daily_dir, rebalance, one_day=num_days == 1)
    written = sorted(d for d, files in stored().items() if files != before.get(d))
    days = load_days(spark, daily_dir, written)
    return range_status(chosen.limit(0) if days is None else days, start_day, num_days)


def process_daily(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    day: str,
    daily_dir: str,
    rebalance: bool = True,
) -> None:
    """Raw sources to one stored day."""
    store_day(load_trips(spark, specs), day, daily_dir, rebalance)


def process_daily_range(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    start_day: str,
    daily_dir: str,
    num_days: int = 7,
    rebalance: bool = True,
) -> DataFrame:
    """Raw sources to consecutive stored days."""
    return store_range(load_trips(spark, specs), start_day, daily_dir, num_days, rebalance)


def process_weekly(
    spark: SparkSession,
    daily_dir: str,
    weekly_dir: str,
    as_tables: bool = False,
    database: str | None = None,
    single_week: bool = False,
    weeks: Sequence[str] | None = None,
    since: str | None = None,
    prune: bool = False,
) -> list[str] | None:
    """Publish stored days by week; returns the week names, or None without data.

    One job writes a folder per week. Without ``weeks`` and ``since`` only those weeks are
    written whose days or files are not those of their last publication: a day that is new,
    stored again or removed takes its week along, and no other day is read. ``weeks`` names
    the weeks to publish, ``since`` a day from whose week on weeks are published, changed or
    not; folders and tables of other weeks stay untouched. A published week whose days have
    all left the store stays as it is, or goes with ``prune``. With ``as_tables`` each folder also becomes a catalog table named
    after its week. Every row goes to the week of its own day; ``single_week`` keeps the older
    habit of putting all stored days into the week of the first one.
    """
    stored = {d: week_name_of(date.fromisoformat(d)) for d in
              key_folders(spark, daily_dir, "pickup_date")}
    if single_week and stored:
        stored = dict.fromkeys(stored, stored[min(stored)])
    wanted = set(stored.values()) if weeks is None else set(weeks)
    all_of_them = weeks is None and since is None
    if prune and all_of_them and stored:  # an empty store is a wrong path more likely
        gone = set(key_folders(spark, weekly_dir, "week_name")) - wanted
        for name in gone if as_tables else ():
            unregister_week(spark, weekly_dir, name, f"{database}.{name}" if database else name)
        remove_weeks(spark, weekly_dir, gone)
    if since is not None:
        first = week_name_of(parse_day(since))
        later = {w for d, w in stored.items() if d >= since or w == first}
        wanted &= later
    files = files_of_days(spark, daily_dir, [d for d, w in stored.items() if w in wanted])
    made_of: dict[str, dict[str, frozenset[str]]] = {}
    for day, names in files.items():
        if names:  # a folder without files is no stored day
            made_of.setdefault(stored[day], {})[day] = names
    if not made_of:
        return None
    now = set(made_of)
    if all_of_them:
        now = changed_weeks(spark, daily_dir, weekly_dir, made_of)
    days = load_days(spark, daily_dir, sorted(d for w in now for d in made_of[w]))
    if days is not None:
        # Named by day folder, and stored days sit together already: no join and no shuffle.
        week = F.lit(min(now)) if single_week else week_name(F.col("pickup_date"))
        rows = days.withColumn("week_name", week).drop("pickup_date")
        save_weeks(rows, weekly_dir, rebalance=False)
        record(spark, daily_dir, weekly_dir, {w: made_of[w] for w in now})
    if as_tables:
        for name in sorted(made_of):
            register_week(spark, weekly_dir, name, f"{database}.{name}" if database else name)
    return sorted(made_of)
