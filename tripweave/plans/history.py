"""Daily facts and day statistics that follow the daily store, day by day.

A history holds the daily facts of every stored day and, per week and type, the number of
days, their trips and the squares of these. A new, changed or removed day is seen by its
files: only the trips of such days are read, what they counted before is taken away from the
statistics and what they count now is added. These are whole numbers, so the outcome equals
that of a run over all trips, whatever the order of the days was.

Each update writes tables of its own and then one small file that names them. A job that dies
before that file is whole leaves the history as it was. One writer at a time; an update
removes the tables that it replaces, so frames of a history are for use before the next one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.contracts import MetricsConfig
from tripweave.functions.weeks import week_name
from tripweave.operators.anomaly import (
    AnomalyRule,
    anomaly_monitoring,
    day_moments,
    day_statistics,
)
from tripweave.operators.cleaning import clean, with_duration
from tripweave.operators.facts import daily_facts
from tripweave.plans.published import files_of_days
from tripweave.sources.folders import data_files, key_folders, read_text, remove, write_text
from tripweave.sources.stores import load_days

#: Tables of facts above which an update writes them all into one, which reads no trips.
MOST_TABLES = 50
MOMENT_KEYS = ("week_name", "taxi_type")
MOMENTS = "week_name string, taxi_type string, days bigint, trips decimal(38,0), squares decimal(38,0)"


@dataclass(frozen=True)
class History:
    """The daily facts of all stored days, and their moments per week and type."""

    daily: DataFrame
    moments: DataFrame

    def statistics(self, by_week: bool = False) -> DataFrame:
        """Mean and deviation of daily trips per type, or per week and type."""
        keys = MOMENT_KEYS if by_week else MOMENT_KEYS[1:]
        sums = self.moments.groupBy(*keys).agg(*_sums())
        kept = day_statistics(F.col("days"), F.col("trips"), F.col("squares"))
        return sums.select(*keys, *(c.alias(name) for name, c in kept.items()))

    def anomalies(self, rule: AnomalyRule = AnomalyRule()) -> DataFrame:
        """The anomaly table over the whole history; reads no trips."""
        return anomaly_monitoring(self.daily, rule, self.statistics(rule.by_week))


def _sums() -> list[Column]:
    return [
        F.sum("days").alias("days"),
        F.sum("trips").cast("decimal(38,0)").alias("trips"),
        F.sum("squares").cast("decimal(38,0)").alias("squares"),
    ]


def _state(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the last whole state; a state cut short does not count."""
    for name in sorted(data_files(spark, f"{root}/state"), reverse=True):
        try:
            return int(name.split(".")[0]), json.loads(read_text(spark, f"{root}/state/{name}"))
        except ValueError:
            continue
    return 0, {}


def _facts(spark: SparkSession, root: str, days: Mapping[str, str]) -> DataFrame | None:
    """The facts of days, each from the table it stands in."""
    if not days:
        return None
    paths = [f"{root}/facts/table={t}" for t in sorted(set(days.values()))]
    reader = spark.read.option("basePath", f"{root}/facts").option("mergeSchema", True)
    listed = spark.createDataFrame(sorted(days.items()), "day string, table string")
    wanted = listed.select(F.col("day").cast("date").alias("pickup_date"), "table")
    return reader.parquet(*paths).join(wanted, ["pickup_date", "table"], "left_semi").drop("table")


def _moments(daily: DataFrame, sign: int) -> DataFrame:
    """Moments of daily facts, or what takes them away."""
    week = week_name(F.col("pickup_date")).alias("week_name")
    sums = day_moments(F.col("trips"))
    found = daily.groupBy(week, "taxi_type").agg(*(c.alias(k) for k, c in sums.items()))
    return found if sign > 0 else found.withColumns({k: -F.col(k) for k in sums})


def update_history(
    spark: SparkSession, daily_dir: str, history_dir: str, config: MetricsConfig = MetricsConfig()
) -> list[str]:
    """Bring a history up to the daily store; returns the days that differed, in order.

    A day differs if it is new, was stored again or has left the store. Another store or
    another cleaning rule makes all of them differ.
    """
    root = history_dir.rstrip("/")
    limits = [config.min_trip_distance, config.min_total_amount, config.min_passenger_count]
    made_by = {"daily_dir": daily_dir.rstrip("/"), "limits": limits}
    number, state = _state(spark, root)
    noted = state.get("days", {})
    folders = key_folders(spark, daily_dir, "pickup_date")
    files = {d: sorted(f) for d, f in files_of_days(spark, daily_dir, folders).items() if f}
    same = {} if state.get("made_by") != made_by else {
        d: e["table"] for d, e in noted.items() if files.get(d) == e["files"]
    }
    changed = sorted(files.keys() - same.keys())
    differ = sorted(set(changed) | noted.keys() - files.keys())
    if not differ and state:
        return []
    name, tables = f"v{uuid.uuid4().hex}", dict(same)
    trips = load_days(spark, daily_dir, changed) if changed else None
    new = None
    if trips is not None:
        daily_facts(clean(with_duration(trips), config)).write.parquet(f"{root}/facts/table={name}")
        tables |= dict.fromkeys(changed, name)
        new = _facts(spark, root, dict.fromkeys(changed, name))
    replaced = {d: e["table"] for d, e in noted.items() if d not in same}
    old = _facts(spark, root, replaced)
    merged = spark.createDataFrame([], MOMENTS)
    if state:
        merged = spark.read.schema(MOMENTS).parquet(f"{root}/moments/{state['moments']}")
    for facts, sign in ((new, 1), (old, -1)):
        if facts is not None:
            merged = merged.unionByName(_moments(facts, sign))
    left = merged.groupBy(*MOMENT_KEYS).agg(*_sums()).filter("days > 0")
    left.coalesce(1).write.parquet(f"{root}/moments/{name}")  # a row per week and type
    if len(set(tables.values())) > MOST_TABLES:
        whole = f"{name}all"
        _facts(spark, root, tables).coalesce(1).write.parquet(f"{root}/facts/table={whole}")
        tables = dict.fromkeys(tables, whole)
    days = {d: {"files": files[d], "table": t} for d, t in tables.items()}
    text = json.dumps({"made_by": made_by, "moments": name, "days": days}, sort_keys=True)
    write_text(spark, f"{root}/state/{number + 1:012d}.json", text)
    for table in set(key_folders(spark, f"{root}/facts", "table")) - set(tables.values()):
        remove(spark, f"{root}/facts/table={table}")
    if state:
        remove(spark, f"{root}/moments/{state['moments']}")
        remove(spark, f"{root}/state/{number:012d}.json")
    return differ


def open_history(spark: SparkSession, history_dir: str) -> History | None:
    """The history as of its last update; None if there is none or it holds no day."""
    root = history_dir.rstrip("/")
    _, state = _state(spark, root)
    daily = _facts(spark, root, {d: e["table"] for d, e in state.get("days", {}).items()})
    if daily is None:
        return None
    moments = spark.read.schema(MOMENTS).parquet(f"{root}/moments/{state['moments']}")
    return History(daily, moments)
