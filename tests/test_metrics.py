"""Cleaning, the metric tables and the anomaly flag, against hand-made answers."""

import math
import random
import statistics
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import as_dicts, trip
from tripweave.contracts import DataValidationError, MetricsConfig, SchemaError
from tripweave.operators import anomaly, cleaning, days, facts, metrics, quality

NAN = float("nan")


def r2(x):
    return float(np.round(x, 2))


def random_trips(n=3000, seed=5):
    """Trips over six weeks of two types and a hot day, with all kinds of bad values."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        start = datetime(2024, 1, 25) + timedelta(seconds=pick.randrange(42 * 86400))
        if i % 3 == 0:
            start = datetime(2024, 2, 8) + timedelta(seconds=pick.randrange(86400))
        end = start + timedelta(seconds=pick.randrange(-600, 7200))
        bad = pick.choice([None, NAN, 0.0, -1.0])
        row = [
            start,
            end,
            float(pick.randrange(1, 6)),
            pick.randrange(1, 3000) / 100,
            pick.randrange(100, 9000) / 100,
            pick.randrange(100, 12000) / 100,
            pick.choice(["Green", "Yellow", "Yellow"]),
        ]
        if pick.random() < 0.15:
            row[pick.choice([2, 3, 4, 5])] = bad
        if pick.random() < 0.02:
            row[pick.choice([0, 1, 6])] = None
        rows.append(tuple(row))
    return rows


def number(x):
    return x is not None and not math.isnan(x)


def brute_force(rows):
    """(day, type) -> list of cleaned trips, as (hour, distance, fare, total, pax, minutes)."""
    groups = defaultdict(list)
    for start, end, pax, distance, fare, total, kind in rows:
        if not all(number(x) and x > 0 for x in (distance, total, pax)):
            continue
        if start is None or kind is None:
            continue
        minutes = None if end is None else r2((end - start).total_seconds() / 60)
        groups[start.date().isoformat(), kind].append(
            (start.hour, distance, fare, total, pax, minutes)
        )
    return groups


def mean(values):
    """Rounded mean of the known values; sums are exact before the division."""
    known = [v for v in values if number(v)]
    return r2(round(math.fsum(known), 6) / len(known)) if known else None


@pytest.fixture(scope="module")
def rows():
    return random_trips()


@pytest.fixture(scope="module")
def cleaned(make_trips, rows):
    return cleaning.clean(cleaning.with_duration(make_trips(rows)))


@pytest.fixture(scope="module")
def daily(cleaned):
    return facts.daily_facts(cleaned)


@pytest.fixture(scope="module")
def groups(rows):
    return brute_force(rows)


def in_order(table):
    return metrics.in_order(table).collect()


def keyed(df, *names):
    return {(r["date"], r["taxi_type"]): tuple(r[n] for n in names) for r in df.collect()}


def test_trips_and_revenue_per_day(daily, groups):
    assert keyed(metrics.trips_per_day(daily), "total_trips") == {
        k: (len(v),) for k, v in groups.items()
    }
    assert keyed(metrics.revenue_per_day(daily), "total_revenue_per_day") == {
        k: (r2(math.fsum(t[3] for t in v)),) for k, v in groups.items()
    }


def test_metric_tables_are_sorted(daily, cleaned):
    table = metrics.in_order(metrics.trips_per_day(daily))
    found = [(r["date"], r["taxi_type"]) for r in table.collect()]
    assert found == sorted(found)
    hourly = metrics.in_order(metrics.hourly_trips(facts.hourly_facts(cleaned))).collect()
    hours = [(r["date"], r["taxi_type"], r["pickup_hour"]) for r in hourly]
    assert hours == sorted(hours)


def test_daily_averages_skip_missing_values_per_column(daily, groups):
    names = [
        "avg_trip_distance",
        "avg_fare_amount",
        "avg_total_amount",
        "avg_passenger_count",
        "avg_trip_duration_minutes",
    ]
    assert keyed(metrics.daily_averages(daily), *names) == {
        k: tuple(mean(t[i] for t in v) for i in range(1, 6)) for k, v in groups.items()
    }


def test_hourly_trips(cleaned, groups):
    expected = defaultdict(int)
    for (day, kind), trips in groups.items():
        for t in trips:
            expected[day, kind, t[0]] += 1
    hourly = metrics.hourly_trips(facts.hourly_facts(cleaned))
    found = {tuple(r)[:3]: r["trips_per_hour"] for r in hourly.collect()}
    assert found == expected


def test_facts_agree_however_they_are_built(make_trips, rows, cleaned, daily):
    timed = cleaning.with_duration(make_trips(rows))
    audited = facts.audited_facts(timed, cleaning.is_clean(timed))
    rolled = facts.daily_from_hourly(facts.kept_facts(audited))
    for table in (metrics.trips_per_day, metrics.revenue_per_day, metrics.daily_averages):
        assert in_order(table(rolled)) == in_order(table(daily))
    counted = cleaning.cleaning_metrics(timed).first()
    assert facts.audit(audited).first() == counted
    assert counted["initial_rows"] == len(rows)
    assert counted["initial_rows"] == counted["final_rows"] + counted["removed_rows"]
    assert counted["final_rows"] == cleaned.count()


def test_results_do_not_depend_on_the_partitioning(make_trips, rows, daily):
    for n in (1, 7, 23):
        spread = make_trips(rows).repartition(n)
        again = facts.daily_facts(cleaning.clean(cleaning.with_duration(spread)))
        assert in_order(metrics.daily_averages(again)) == in_order(metrics.daily_averages(daily))
        assert in_order(metrics.revenue_per_day(again)) == in_order(metrics.revenue_per_day(daily))
        assert in_order(anomaly.anomaly_monitoring(again)) == in_order(
            anomaly.anomaly_monitoring(daily)
        )


def test_cleaning_thresholds_are_configurable(make_trips):
    trips = make_trips([trip(distance=1.0), trip(distance=1.5), trip(passengers=3.0, distance=9.0)])
    config = MetricsConfig(min_trip_distance=1.0, min_passenger_count=2)
    assert cleaning.clean(trips, MetricsConfig(min_trip_distance=1.0)).count() == 2
    assert cleaning.clean(trips, config).count() == 1


def test_cleaning_nothing(make_trips):
    empty = make_trips([trip()]).filter("false")
    assert cleaning.cleaning_metrics(empty).first().asDict() == {
        "initial_rows": 0,
        "final_rows": 0,
        "removed_rows": 0,
        "removed_pct": 0.0,
    }


def test_duration_columns(make_trips):
    trips = make_trips([trip()])
    given = trips.withColumn("trip_duration_minutes", F.lit(99.0))
    assert cleaning.with_duration(given).first()["trip_duration_minutes"] == 99.0
    both = trips.withColumn("lpep_dropoff_datetime", F.expr("pickup_datetime + interval 3 minutes"))
    assert cleaning.with_duration(both).first()["trip_duration_minutes"] == 3.0
    with pytest.raises(DataValidationError):
        cleaning.with_duration(trips.withColumnRenamed("dropoff_datetime", "tpep_dropoff_datetime"))
    text = trips.withColumns({c: F.col(c).cast("string") for c in trips.columns[:2]})
    assert cleaning.with_duration(text).first()["trip_duration_minutes"] == 10.0


def test_other_profiles(make_trips):
    rows = [
        trip(),
        trip(passengers=7.0),
        trip(fare=0.0),
        trip(dropoff="2024-01-01 07:00:00"),
        trip(dropoff=None),
        trip(pickup=None),
        trip(distance=NAN),
    ]
    trips = cleaning.with_duration(make_trips(rows))
    assert cleaning.clean(trips).count() == 6
    assert cleaning.clean_strict(trips).count() == 1
    assert cleaning.clean_middle(trips).count() == 2
    counted = cleaning.invalid_by_reason(trips).collect()
    reasons = {r["metric"]: (r["before"], r["after"]) for r in counted}
    assert reasons == {
        "total_records": (7, 2),
        "invalid_distance": (1, 0),
        "invalid_fare": (1, 0),
        "null_timestamps": (2, 0),
    }


def test_missing_measures_only_hurt_the_metrics_that_need_them(make_trips):
    few = facts.daily_facts(make_trips([trip()]).select("pickup_datetime", "taxi_type"))
    assert metrics.trips_per_day(few).count() == 1
    with pytest.raises(SchemaError):
        metrics.daily_averages(few)
    with pytest.raises(SchemaError):
        facts.daily_facts(make_trips([trip()]).drop("taxi_type"))


# --- anomaly flag ----------------------------------------------------------------


def counts_to_trips(counts, kind="Green", first="2024-01-01", passengers=1.0):
    start = datetime.fromisoformat(first)
    return [
        (day, day + timedelta(minutes=5), passengers, 1.0, 1.0, 2.0, kind)
        for day, n in ((start + timedelta(days=i), n) for i, n in enumerate(counts))
        for _ in range(n)
    ]


def flags(make_trips, rows, rule=anomaly.AnomalyRule()):
    flagged = anomaly.anomaly_monitoring(facts.daily_facts(make_trips(rows)), rule)
    return {(r["date"][8:], r["taxi_type"]): r for r in flagged.collect()}


WIDE = anomaly.AnomalyRule(std_threshold=1e9)


def test_drop_of_exactly_twenty_percent_is_not_flagged(make_trips):
    found = flags(make_trips, counts_to_trips([100, 80, 63, 63]), WIDE)
    assert [found[d, "Green"]["pct_change_trips"] for d in ("01", "02", "03", "04")] == [
        None,
        -20.0,
        -21.25,
        0.0,
    ]
    assert [found[d, "Green"]["is_anomaly"] for d in ("01", "02", "03", "04")] == [
        False,
        False,
        True,
        False,
    ]


def test_drop_is_compared_after_rounding(make_trips):
    """-20.004 % rounds to -20.00 and passes."""
    found = flags(make_trips, counts_to_trips([2499, 1999]), WIDE)
    assert found["02", "Green"]["pct_change_trips"] == r2(-500 / 2499 * 100)
    assert found["02", "Green"]["is_anomaly"] is (found["02", "Green"]["pct_change_trips"] < -20)


@pytest.mark.parametrize(("extra", "mean_value", "flag"), [(2, 2.0, False), (3, 2.01, True)])
def test_passenger_mean_is_compared_after_rounding(make_trips, extra, mean_value, flag):
    rows = counts_to_trips([500 - extra], passengers=2.0) + counts_to_trips([extra], passengers=3.0)
    found = flags(make_trips, rows, WIDE)["01", "Green"]
    assert (found["avg_passenger_count"], found["is_anomaly"]) == (mean_value, flag)


def test_single_day_has_no_deviation_and_no_flag(make_trips):
    found = flags(make_trips, counts_to_trips([5]))["01", "Green"]
    assert found["stddev_trips"] is None and found["pct_change_trips"] is None
    assert found["is_anomaly"] is False


def test_statistics_per_type_and_gaps(make_trips):
    green, yellow = [10, 10, 10, 10, 40], [7, 0, 7]
    rows = counts_to_trips(green) + counts_to_trips(yellow, "Yellow")
    found = flags(make_trips, rows)
    assert found["05", "Green"]["avg_trips"] == 16.0
    assert found["05", "Green"]["stddev_trips"] == pytest.approx(statistics.stdev(green))
    assert [found[f"0{i}", "Green"]["is_anomaly"] for i in range(1, 6)] == [False] * 4 + [True]
    assert ("02", "Yellow") not in found
    assert found["03", "Yellow"]["pct_change_trips"] == 0.0


def test_weekly_scope_keeps_weeks_apart(make_trips):
    rows = counts_to_trips([10] * 7 + [50] * 7)
    whole = flags(make_trips, rows)
    by_week = flags(make_trips, rows, anomaly.AnomalyRule(by_week=True))
    assert whole["08", "Green"]["pct_change_trips"] == 400.0
    assert by_week["08", "Green"]["pct_change_trips"] is None
    assert by_week["08", "Green"]["avg_trips"] == 50.0


def test_documented_rule_looks_at_revenue(make_trips):
    rows = counts_to_trips([10, 10]) + [
        (*row[:5], 0.5, row[6]) for row in counts_to_trips([10], first="2024-01-03")
    ]
    found = flags(make_trips, rows, anomaly.DOCUMENTED_RULE)
    assert found["03", "Green"]["pct_change_trips"] == 0.0
    assert found["03", "Green"]["pct_change_revenue"] == -75.0
    assert found["03", "Green"]["is_anomaly"] is True
    details = as_dicts(anomaly.anomaly_details(facts.daily_facts(make_trips(rows))))
    assert [(d["date"], d["anomaly_share_pct"]) for d in details] == [("2024-01-03", 33.33)]


def test_anomaly_agrees_with_the_other_tables(daily):
    flagged = anomaly.anomaly_monitoring(daily)
    assert keyed(flagged, "daily_trips") == keyed(metrics.trips_per_day(daily), "total_trips")
    assert keyed(flagged, "total_revenue_per_day") == keyed(
        metrics.revenue_per_day(daily), "total_revenue_per_day"
    )
    assert flagged.filter("is_anomaly is null").isEmpty()


# --- other queries ---------------------------------------------------------------


def test_peak_hour_tie_goes_to_the_earlier_hour(make_trips):
    rows = [trip(pickup=f"2024-01-01 {h}:00:00") for h in ("09", "09", "07", "07", "03")]
    peak = metrics.peak_hours(facts.hourly_facts(make_trips(rows))).first()
    assert (peak["peak_hour"], peak["peak_trips"]) == (7, 2)


def test_heatmap_covers_all_hours(cleaned, groups):
    found = {r["date"]: r for r in metrics.hour_heatmap(facts.hourly_facts(cleaned)).collect()}
    expected = defaultdict(int)
    for (day, _), trips in groups.items():
        for t in trips:
            expected[day, t[0]] += 1
    for day, row in found.items():
        assert [row[f"h{h:02d}"] for h in range(24)] == [expected.get((day, h)) for h in range(24)]


def test_executive_summary_total_is_over_trips(daily, groups):
    rows = {r["taxi_type"]: r for r in metrics.executive_summary(daily).collect()}
    everything = [t for trips in groups.values() for t in trips]
    assert rows["Total"]["total_trips"] == len(everything)
    assert rows["Total"]["avg_trip_distance"] == mean(t[1] for t in everything)
    parts = [rows[kind]["total_trips"] for kind in ("Green", "Yellow")]
    assert rows["Total"]["total_trips"] == sum(parts)


def test_shares_of_a_week_add_up(daily):
    shares = metrics.weekly_by_type(daily).groupBy("week_name").agg(F.sum("share_pct").alias("s"))
    assert all(r["s"] == pytest.approx(100, abs=0.02) for r in shares.collect())


def test_ratios_guard_zero_denominators(spark):
    averages = spark.createDataFrame(
        [("2024-01-01", "Green", 0.0, 0.0, 5.0, 1.0, 0.0)],
        "date string, taxi_type string, avg_trip_distance double, avg_fare_amount double, "
        "avg_total_amount double, avg_passenger_count double, avg_trip_duration_minutes double",
    )
    row = metrics.type_ratios(averages).first()
    assert (row["speed_mph"], row["fare_per_mile"], row["markup_pct"]) == (None, None, None)


# --- days ------------------------------------------------------------------------


def test_day_boundaries(make_trips, zone):
    trips = make_trips(
        [
            trip(pickup="2024-01-01 23:59:59.999999"),
            trip(pickup="2024-01-02 00:00:00"),
            trip(pickup="2024-01-03 00:00:00"),
            trip(pickup=None),
        ]
    )
    assert days.trips_on(trips, "2024-01-02").count() == 1
    assert days.trips_in_range(trips, "2024-01-01", 2).count() == 2
    per_day = {r["date"]: r["trips"] for r in days.range_status(trips, "2024-01-01", 4).collect()}
    assert per_day == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-03": 1, "2024-01-04": 0}
    table = metrics.in_order(metrics.trips_per_day(facts.daily_facts(trips)))
    assert [r["date"] for r in table.collect()] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    with pytest.raises(ValueError):
        days.trips_on(trips, "yesterday")


def test_iso_week_across_the_new_year(make_trips):
    stamps = ["2024-12-29", "2024-12-30", "2025-01-05", "2025-01-06"]
    trips = make_trips([trip(pickup=f"{d} 12:00:00") for d in stamps])
    assert days.trips_in_iso_week(trips, 2025, 1).count() == 2
    by_function = trips.filter(
        (F.weekofyear("pickup_datetime") == 1)
        & (F.extract(F.lit("YEAROFWEEK"), F.col("pickup_datetime")) == 2025)
    )
    assert by_function.count() == 2


def test_range_status_lists_empty_days(make_trips):
    trips = make_trips([trip(), trip(), trip(pickup="2024-01-03 00:00:00")])
    status = days.range_status(trips, "2024-01-01", 4)
    assert [(r["date"][8:], r["trips"], r["status"]) for r in status.collect()] == [
        ("01", 2, "processed"),
        ("02", 0, "skipped"),
        ("03", 1, "processed"),
        ("04", 0, "skipped"),
    ]
    assert tuple(days.range_totals(status).first()) == (4, 2, 2)


# --- looking at tables -----------------------------------------------------------


def test_null_counts_include_nan(make_trips):
    trips = make_trips([trip(), trip(fare=NAN), trip(fare=None), trip(kind=None)])
    counts = {r["column_name"]: r["null_count"] for r in quality.null_counts(trips).collect()}
    assert counts["fare_amount"] == 2 and counts["taxi_type"] == 1 and counts["trip_distance"] == 0


def test_numeric_summary_ignores_nan(make_trips):
    trips = make_trips([trip(fare=1.0), trip(fare=3.0), trip(fare=NAN), trip(fare=None)])
    summary = quality.numeric_summary(trips)
    row = summary.filter("column_name = 'fare_amount'").first()
    assert (row["value_count"], row["mean"], row["min"], row["max"]) == (2, 2.0, 1.0, 3.0)


def test_quartiles_are_values_at_their_rank(spark):
    rng = random.Random(2)
    values = {
        "ties": [float(rng.randrange(4)) for _ in range(401)],
        "spread": [rng.uniform(-1e9, 1e9) for _ in range(401)],
        "gaps": [None if i % 3 else float(i) for i in range(401)],
        "none": [None] * 401,
        "hot": [7.0] * 400 + [9.0],
    }
    rows = list(zip(*values.values(), strict=True))
    ddl = ", ".join(f"{c} double" for c in values)
    answers = []
    for parts in (1, 8):
        df = spark.createDataFrame(rows, ddl).repartition(parts)
        answers.append(sorted(map(tuple, quality.numeric_summary(df).collect())))
    assert answers[0] == answers[1]  # to the bit
    for name, n, mean, deviation, low, q25, q50, q75, high in answers[0]:
        known = sorted(v for v in values[name] if v is not None)
        assert n == len(known)
        if not known:
            assert (mean, deviation, low, q25, q50, q75, high) == (None,) * 7
            continue
        ranks = [known[math.ceil(k * n / 4) - 1] for k in (1, 2, 3)]
        assert [low, q25, q50, q75, high] == [known[0], *ranks, known[-1]]
        assert mean == pytest.approx(statistics.fmean(known), rel=1e-9)
        assert deviation == pytest.approx(statistics.stdev(known), rel=1e-9)
    one = quality.numeric_summary(spark.createDataFrame([(5,)], "x int")).first()
    assert tuple(one) == ("x", 1, 5.0, None, 5.0, 5.0, 5.0, 5.0, 5.0)
    empty = quality.numeric_summary(spark.createDataFrame([], "x int")).first()
    assert tuple(empty) == ("x", 0, *[None] * 7)


def test_schema_listing(make_trips):
    listing = quality.schema_listing(make_trips([trip(), trip()])).orderBy("position").collect()
    assert listing[0]["data_type"] == "timestamp_ntz"
    assert {(r["total_rows"], r["total_columns"]) for r in listing} == {(2, 7)}


def test_null_counts_of_dotted_names(spark):
    df = spark.createDataFrame([(None, 1.0), (2, float("nan"))], "`a.b` long, `c d` double")
    assert dict(map(tuple, quality.null_counts(df).collect())) == {"a.b": 1, "c d": 1}


def test_anomaly_share_follows_the_rule(daily):
    rule = anomaly.AnomalyRule(by_week=True)
    scored = anomaly.score_days(daily, rule).collect()
    for row in anomaly.anomaly_details(daily, rule).collect():
        week = next(r["week_name"] for r in scored
                    if str(r["pickup_date"]) == row["date"] and r["taxi_type"] == row["taxi_type"])
        days = [r for r in scored if (r["week_name"], r["taxi_type"]) == (week, row["taxi_type"])]
        share = 100 * sum(r["is_anomaly"] for r in days) / len(days)
        assert row["anomaly_share_pct"] == pytest.approx(share, abs=0.005)
