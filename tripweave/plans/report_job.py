"""From metric files to the weekly report tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tripweave.contracts import REPORT_COLUMNS
from tripweave.operators.report import daily_breakdown, ranked_hours, weekly_kpis
from tripweave.session import at_once
from tripweave.sources.metric_files import read_all_weeks_metric, read_week_metric


@dataclass(frozen=True)
class Report:
    kpis: DataFrame
    breakdown: DataFrame
    busiest: DataFrame


def build_report(tables: dict[str, DataFrame], week: str | None = None) -> Report:
    """Report tables out of the five metric tables; see `operators.report`."""
    return Report(
        weekly_kpis(tables, week),
        daily_breakdown(tables["trips_per_day"], tables["revenue_per_day"]),
        ranked_hours(tables["peak_hour_per_day"], week=week),
    )


def report_week(spark: SparkSession, output_dir: str, week: str) -> Report:
    """The report of one week from the files of `run_week`."""
    slugs = list(REPORT_COLUMNS)
    frames = at_once(spark, [partial(read_week_metric, spark, output_dir, week, s) for s in slugs])
    return build_report(dict(zip(slugs, frames, strict=True)), week)


def report_all_weeks(spark: SparkSession, output_dir: str) -> Report:
    """The reports of all weeks from the files of `run_all_weeks`."""
    slugs = list(REPORT_COLUMNS)
    frames = at_once(spark, [partial(read_all_weeks_metric, spark, output_dir, s) for s in slugs])
    return build_report(dict(zip(slugs, frames, strict=True)))
