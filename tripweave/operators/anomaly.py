"""Day-level anomaly flags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.contracts import (
    ANOMALY_PASSENGER_LIMIT,
    ANOMALY_PCT_CHANGE_THRESHOLD,
    ANOMALY_STD_THRESHOLD,
    DOCUMENTED_STD_THRESHOLD,
    MetricsConfig,
    require_columns,
)
from tripweave.functions.numbers import pct_change, round2
from tripweave.functions.weeks import week_name
from tripweave.operators.metrics import average, day_column, revenue


@dataclass(frozen=True)
class AnomalyRule:
    """When a day is flagged.

    ``drop_column`` is the percentage that is held against ``pct_threshold``: the change
    of trips or of revenue. With ``by_week`` the statistics and the previous day stay
    within a week name; otherwise they span the whole input.
    """

    std_threshold: float = ANOMALY_STD_THRESHOLD
    pct_threshold: float = ANOMALY_PCT_CHANGE_THRESHOLD
    passenger_limit: float = ANOMALY_PASSENGER_LIMIT
    drop_column: str = "pct_change_trips"
    by_week: bool = False

    @classmethod
    def from_config(cls, config: MetricsConfig, by_week: bool = False) -> AnomalyRule:
        return cls(
            config.anomaly_std_threshold,
            config.anomaly_pct_change_threshold,
            config.anomaly_passenger_limit,
            by_week=by_week,
        )


# Two standard deviations and a fall of revenue, as described in the documents.
DOCUMENTED_RULE = AnomalyRule(
    std_threshold=DOCUMENTED_STD_THRESHOLD, drop_column="pct_change_revenue"
)


def _flag(rule: AnomalyRule) -> Column:
    trips, band = F.col("daily_trips"), F.lit(rule.std_threshold) * F.col("stddev_trips")
    reasons = (
        trips > F.col("avg_trips") + band,
        trips < F.col("avg_trips") - band,
        F.col(rule.drop_column) < F.lit(rule.pct_threshold),
        F.col("avg_passenger_count") > F.lit(rule.passenger_limit),
    )
    no = F.lit(False)
    flag = no
    for reason in reasons:
        flag = flag | F.coalesce(reason, no)
    return flag


def day_moments(trips: Column) -> dict[str, Column]:
    """Aggregates over the trips of days: their number, sum and sum of squares.

    All three are whole numbers, so they can be added, and taken away again, in any order.
    """
    exactly = trips.cast("decimal(14,0)")
    return {
        "days": F.count(F.lit(1)),
        "trips": F.sum(exactly),
        "squares": F.sum(exactly * exactly),
    }


def day_statistics(days: Column, trips: Column, squares: Column) -> dict[str, Column]:
    """Mean and sample deviation out of day moments; one day has no deviation."""
    n = days.cast("double")
    spread = (days.cast("decimal(9,0)") * squares - trips * trips).cast("double")
    return {
        "avg_trips": trips.cast("double") / n,
        "stddev_trips": F.when(days > 1, F.sqrt(spread / (n * (n - 1)))),
    }


def score_days(
    daily: DataFrame, rule: AnomalyRule = AnomalyRule(), statistics: DataFrame | None = None
) -> DataFrame:
    """All columns of both flag variants.

    The windows run over daily facts, a handful of rows per type and week. The previous
    day is the previous row: days without trips are not filled in. The statistics come from
    whole numbers, so that a rerun gives the same deviation to the last bit; who keeps them
    already (``plans.history``) hands them over, one row per type, or per week and type for
    a rule by week.
    """
    require_columns(daily, ["total_amount_sum", "passenger_count_sum"], "anomaly_monitoring")
    days = daily.select(
        "pickup_date",
        week_name(F.col("pickup_date")).alias("week_name"),
        "taxi_type",
        F.col("trips").alias("daily_trips"),
        revenue().alias("total_revenue_per_day"),
        round2(average("passenger_count")).alias("avg_passenger_count"),
    )
    keys = [*(["week_name"] if rule.by_week else []), "taxi_type"]
    in_order = Window.partitionBy(*keys).orderBy("pickup_date")
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def previous(name: str) -> Column:
        return F.lag(name).over(in_order)

    if statistics is None:
        moments = {k: c.over(everything) for k, c in day_moments(F.col("daily_trips")).items()}
        known = days.withColumns(moments)
        known = known.withColumns(day_statistics(*(F.col(k) for k in moments))).drop(*moments)
    else:
        known = days.join(statistics, keys, "left")
    scored = known.withColumns(
        {
            "prev_trips": previous("daily_trips"),
            "prev_revenue": previous("total_revenue_per_day"),
        }
    ).withColumns(
        {
            "pct_change_trips": pct_change(F.col("daily_trips"), F.col("prev_trips")),
            "pct_change_revenue": pct_change(
                F.col("total_revenue_per_day"), F.col("prev_revenue")
            ),
        }
    )
    return scored.withColumn("is_anomaly", _flag(rule))


def anomaly_monitoring(
    daily: DataFrame, rule: AnomalyRule = AnomalyRule(), statistics: DataFrame | None = None
) -> DataFrame:
    """The anomaly metric table. A rule on revenue adds its percentage column."""
    changes = dict.fromkeys(["pct_change_trips", rule.drop_column])
    return score_days(daily, rule, statistics).select(
        day_column(),
        "taxi_type",
        "daily_trips",
        "total_revenue_per_day",
        "avg_passenger_count",
        "avg_trips",
        "stddev_trips",
        *changes,
        "is_anomaly",
    )


def anomaly_details(daily: DataFrame, rule: AnomalyRule = DOCUMENTED_RULE) -> DataFrame:
    """The flagged days with both changes, and the flagged share of the type's days.

    The share is taken over the days the rule's statistics are: all, or those of the week.
    """
    scope = Window.partitionBy(*(["week_name"] if rule.by_week else []), "taxi_type")
    share = F.count_if("is_anomaly").over(scope) / F.count(F.lit(1)).over(scope) * F.lit(100.0)
    return (
        score_days(daily, rule)
        .withColumn("anomaly_share_pct", round2(share))
        .filter("is_anomaly")
        .select(
            day_column(),
            "taxi_type",
            "daily_trips",
            "pct_change_trips",
            "total_revenue_per_day",
            "pct_change_revenue",
            "anomaly_share_pct",
        )
        .orderBy("date", "taxi_type")
    )
