"""From trips to metric files with one scan of the trips."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.contracts import MetricsConfig
from tripweave.functions.weeks import week_name
from tripweave.operators.cleaning import clean, is_clean, with_duration
from tripweave.operators.facts import audit, audited_facts, kept_facts
from tripweave.operators.sinks import save_metric, save_metric_all_weeks
from tripweave.plans.registry import MetricRegistry, default_registry
from tripweave.session import at_once, shared_dir
from tripweave.sources.folders import remove
from tripweave.sources.stores import load_week, load_week_table


@dataclass(frozen=True)
class MetricsRun:
    """The metric tables of a run by slug, and its audited facts, all read from files.

    The run owns the folder of its facts. `close` removes it, as does leaving a ``with``
    block; its frames are of no use after that.
    """

    tables: dict[str, DataFrame]
    audited: DataFrame
    facts_dir: str

    def close(self) -> None:
        remove(self.audited.sparkSession, self.facts_dir)

    def __enter__(self) -> MetricsRun:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def cleaning(self) -> DataFrame:
        return audit(self.audited)

    def cleaning_by_week(self) -> DataFrame:
        """Cleaning numbers per week; trips without a pickup time belong to none."""
        week = week_name(F.col("pickup_date")).alias("week_name")
        return audit(self.audited.filter("pickup_date IS NOT NULL"), week)


def prepare(
    trips: DataFrame,
    config: MetricsConfig = MetricsConfig(),
    registry: MetricRegistry | None = None,
    by_week: bool = False,
) -> MetricsRun:
    """Scan the trips once and write their facts to the shared folder.

    The facts have one row per day, hour and type. The metric tables read that table,
    so neither they nor a lost executor bring the scan back.
    """
    spark = trips.sparkSession
    timed = with_duration(trips)
    path = shared_dir(spark, "facts")
    planned = audited_facts(timed, is_clean(timed, config))
    planned.write.parquet(path)
    audited = spark.read.schema(planned.schema).parquet(path)
    chosen = registry or default_registry(config, by_week)
    return MetricsRun(chosen.tables(clean(timed, config), kept_facts(audited)), audited, path)


def run_week(
    spark: SparkSession,
    week: str,
    output_dir: str,
    weekly_dir: str | None = None,
    config: MetricsConfig = MetricsConfig(),
    registry: MetricRegistry | None = None,
) -> MetricsRun:
    """Metric files of one week, from the weekly store or else from its catalog table."""
    if weekly_dir is None:
        trips = load_week_table(spark, week)
    else:
        trips = load_week(spark, weekly_dir, week)
    return run_trips(trips, week, output_dir, config, registry)


def run_trips(
    trips: DataFrame,
    week: str,
    output_dir: str,
    config: MetricsConfig = MetricsConfig(),
    registry: MetricRegistry | None = None,
) -> MetricsRun:
    """Metric files of trips that all count as one week."""
    run = prepare(trips, config, registry)
    at_once(
        trips.sparkSession,
        [partial(save_metric, t, output_dir, week, slug) for slug, t in run.tables.items()],
    )
    return run


def run_all_weeks(
    trips: DataFrame,
    output_dir: str,
    config: MetricsConfig = MetricsConfig(),
    registry: MetricRegistry | None = None,
) -> MetricsRun:
    """Metric files of every week in one job; statistics stay within each week."""
    run = prepare(trips, config, registry, by_week=True)
    at_once(
        trips.sparkSession,
        [partial(save_metric_all_weeks, t, output_dir, slug) for slug, t in run.tables.items()],
    )
    return run
