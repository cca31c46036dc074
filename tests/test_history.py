"""Histories that follow a daily store, against runs over all trips."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import trip
from tripweave.contracts import MetricsConfig
from tripweave.operators import anomaly, cleaning, facts, sinks
from tripweave.plans import history
from tripweave.plans.history import open_history, update_history
from tripweave.sources.folders import remove
from tripweave.sources.stores import load_days

RULES = [anomaly.AnomalyRule(), anomaly.AnomalyRule(by_week=True), anomaly.DOCUMENTED_RULE]


def day_of(day, n, kind="Green", passengers=1.0):
    return [trip(pickup=f"{day} {i % 24:02d}:10:00", total=10.0 + i / 7, kind=kind,
                 passengers=passengers) for i in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def assert_equals_full_run(spark, store, kept, config=MetricsConfig()):
    """To the last bit, for every rule."""
    trips = cleaning.clean(cleaning.with_duration(load_days(spark, store)), config)
    daily = facts.daily_facts(trips)
    current = open_history(spark, kept)
    for rule in RULES:
        assert rows(current.anomalies(rule)) == rows(anomaly.anomaly_monitoring(daily, rule))


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "daily"), str(tmp_path / "history")


def test_days_come_change_and_go(spark, make_trips, places):
    store, kept = places
    days = {"2024-03-01": 9, "2024-03-02": 11, "2024-03-09": 4, "2024-04-02": 30}
    first = [t for d, n in days.items() for t in day_of(d, n)] + day_of("2024-03-02", 5, "Yellow")
    sinks.save_days(make_trips(first), store)
    assert update_history(spark, store, kept) == sorted(days)
    assert_equals_full_run(spark, store, kept)
    assert update_history(spark, store, kept) == []
    sinks.save_days(make_trips(day_of("2024-04-03", 2) + day_of("2024-03-09", 90, "Yellow")), store)
    assert update_history(spark, store, kept) == ["2024-03-09", "2024-04-03"]
    assert_equals_full_run(spark, store, kept)
    remove(spark, f"{store}/pickup_date=2024-03-01")
    sinks.save_days(make_trips(day_of("2024-05-01", 3, passengers=0.0)), store)  # none is clean
    assert update_history(spark, store, kept) == ["2024-03-01", "2024-05-01"]
    assert_equals_full_run(spark, store, kept)
    looser = MetricsConfig(min_passenger_count=-1)
    assert len(update_history(spark, store, kept, looser)) == 5
    assert_equals_full_run(spark, store, kept, looser)


def test_other_days_are_not_read(spark, make_trips, places):
    store, kept = places
    sinks.save_days(make_trips(day_of("2024-03-01", 9) + day_of("2024-03-02", 5)), store)
    update_history(spark, store, kept)
    for file in Path(store).glob("pickup_date=*/*.parquet"):
        file.write_bytes(b"no trips")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    sinks.save_days(make_trips(day_of("2024-03-03", 7)), store)
    assert update_history(spark, store, kept) == ["2024-03-03"]
    found = open_history(spark, kept).anomalies().collect()
    assert [r["daily_trips"] for r in sorted(found)] == [9, 5, 7]
    assert {r["avg_trips"] for r in found} == {7.0} and {r["stddev_trips"] for r in found} == {2.0}


def test_a_state_cut_short_does_not_count(spark, make_trips, places):
    store, kept = places
    assert open_history(spark, kept) is None
    assert update_history(spark, store, kept) == []
    assert open_history(spark, kept) is None
    sinks.save_days(make_trips(day_of("2024-03-01", 9)), store)
    update_history(spark, store, kept)
    Path(kept, "state", "000000000009.json").write_text('{"days": {"2024-0')
    assert_equals_full_run(spark, store, kept)
    sinks.save_days(make_trips(day_of("2024-03-02", 4)), store)
    assert update_history(spark, store, kept) == ["2024-03-02"]
    assert_equals_full_run(spark, store, kept)


def test_many_updates_share_a_table(spark, make_trips, places, monkeypatch):
    monkeypatch.setattr(history, "MOST_TABLES", 2)
    store, kept = places
    for k in range(1, 6):
        sinks.save_days(make_trips(day_of(f"2024-03-0{k}", 3 * k)), store)
        update_history(spark, store, kept)
        assert len(list(Path(kept, "facts").glob("table=*"))) <= 2
    assert_equals_full_run(spark, store, kept)


def test_large_counts_stay_exact(spark):
    counts = [90_000_000_000_000 + k for k in range(3)]
    days = spark.createDataFrame([(n,) for n in counts], "trips long")
    sums = days.agg(*(c.alias(k) for k, c in anomaly.day_moments(F.col("trips")).items()))
    found = sums.select(
        *(c.alias(k) for k, c in anomaly.day_statistics(*map(F.col, sums.columns)).items())
    ).first()
    assert tuple(found) == (90_000_000_000_001.0, 1.0)
