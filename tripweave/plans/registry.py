"""The metrics of a job, in order, and a place to plug in more."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame

from tripweave.contracts import METRIC_NAMES, AggregationError, MetricsConfig
from tripweave.functions.weeks import metric_file_name
from tripweave.operators import metrics
from tripweave.operators.anomaly import AnomalyRule, anomaly_monitoring
from tripweave.operators.facts import daily_facts, daily_from_hourly, hourly_facts
from tripweave.operators.metrics import in_order

HOURLY, DAILY, TRIPS = "hourly", "daily", "trips"


@dataclass(frozen=True)
class Metric:
    """A named DataFrame function over cleaned trips or over facts derived from them."""

    name: str
    slug: str
    compute: Callable[[DataFrame], DataFrame]
    over: str = TRIPS

    def file_name(self, week: str = "") -> str:
        return metric_file_name(self.slug, week)


class MetricRegistry:
    """Metrics in the order they were registered."""

    def __init__(self, entries: Sequence[Metric] = ()):
        self.entries = list(entries)

    def register(self, metric: Metric) -> MetricRegistry:
        self.entries.append(metric)
        return self

    def enabled(self, slugs: Sequence[str] | None) -> MetricRegistry:
        """Only the metrics with these slugs, in the given order; None keeps all."""
        if slugs is None:
            return self
        known = {m.slug: m for m in self.entries}
        unknown = [s for s in slugs if s not in known]
        if unknown:
            raise AggregationError(f"unknown metrics {unknown}; known ones {list(known)}")
        return MetricRegistry([known[s] for s in slugs])

    def tables(self, trips: DataFrame, facts: DataFrame | None = None) -> dict[str, DataFrame]:
        """Slug -> lazy unsorted table. The first metric that fails ends the run.

        ``trips`` are cleaned trips. Hourly ``facts`` that already exist as a table are
        used instead of a scan of the trips.
        """
        hourly = hourly_facts(trips) if facts is None else facts
        inputs = {
            TRIPS: trips,
            HOURLY: hourly,
            DAILY: daily_facts(trips) if facts is None else daily_from_hourly(hourly),
        }
        results = {}
        for metric in self.entries:
            try:
                results[metric.slug] = metric.compute(inputs[metric.over])
            except Exception as error:
                raise AggregationError(f"failed to compute {metric.name}: {error}") from error
        return results

    def compute_all(
        self, trips: DataFrame, week: str = "", facts: DataFrame | None = None
    ) -> dict[str, tuple[DataFrame, str]]:
        """Name -> (sorted table, file name), in order of registration; see `tables`."""
        tables = self.tables(trips, facts)
        return {m.name: (in_order(tables[m.slug]), m.file_name(week)) for m in self.entries}


def default_registry(
    config: MetricsConfig = MetricsConfig(), by_week: bool = False
) -> MetricRegistry:
    """The five metric tables, cut down to `config.enabled` if that is set."""
    flag = partial(anomaly_monitoring, rule=AnomalyRule.from_config(config, by_week))
    tables = {
        "trips_per_day": (metrics.trips_per_day, DAILY),
        "revenue_per_day": (metrics.revenue_per_day, DAILY),
        "peak_hour_per_day": (metrics.hourly_trips, HOURLY),
        "daily_avg_metrics": (metrics.daily_averages, DAILY),
        "anomaly_monitoring": (flag, DAILY),
    }
    entries = [Metric(METRIC_NAMES[slug], slug, *how) for slug, how in tables.items()]
    return MetricRegistry(entries).enabled(config.enabled)
