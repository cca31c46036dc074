"""Stores, jobs and files end to end."""

from dataclasses import replace
from functools import partial
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from tests.conftest import as_dicts, trip
from tests.test_metrics import random_trips
from tripweave.contracts import AggregationError, MetricsConfig
from tripweave.operators import metrics, sinks
from tripweave.operators.cleaning import with_duration
from tripweave.operators.facts import daily_facts
from tripweave.plans import metrics_job, registry, report_job, storage
from tripweave.plans import published as published_weeks
from tripweave.session import at_once, shared_dir
from tripweave.sources import stores
from tripweave.sources.fleets import GREEN, YELLOW
from tripweave.sources.folders import remove
from tripweave.sources.metric_files import read_week_metric

WEEK = "week_2_february_2024"


@pytest.fixture(scope="module")
def trips(make_trips):
    return make_trips(random_trips(1200))


@pytest.fixture(scope="module")
def daily_dir(trips, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "daily")
    sinks.save_days(trips, path)
    return path


def sorted_rows(df):
    """Rows as text, in order; as text a NaN equals itself."""
    return sorted(repr(tuple(r)) for r in df.select(sorted(df.columns)).collect())


def files_of(folder):
    return sorted(p for p in Path(folder).rglob("part-*") if p.is_file())


# --- days ------------------------------------------------------------------------


def test_storing_a_day_again_changes_nothing_else(spark, trips, tmp_path, zone):
    store = str(tmp_path / "daily")
    sinks.save_days(trips, store)
    before = sorted_rows(stores.load_days(spark, store))
    storage.store_day(trips, "2024-02-08", store)
    storage.store_day(trips, "1999-01-01", store)
    assert sorted_rows(stores.load_days(spark, store)) == before
    assert len(before) == trips.filter("pickup_datetime is not null").count()


def test_a_day_is_replaced_not_appended(spark, make_trips, tmp_path):
    store = str(tmp_path / "daily")
    day, other = trip(), trip(pickup="2024-01-02 08:00:00")
    sinks.save_days(make_trips([day, day, other]), store)
    sinks.save_days(make_trips([day]), store)
    counts = stores.load_days(spark, store).groupBy("pickup_date").count().orderBy("pickup_date")
    assert [r["count"] for r in counts.collect()] == [1, 1]


def test_storing_a_day_into_an_empty_store(spark, make_trips, tmp_path):
    store = str(tmp_path / "daily")
    storage.store_day(make_trips([trip()]), "2030-01-01", store)
    assert stores.load_days(spark, store) is None


def test_range_job_reports_each_day(spark, trips, tmp_path):
    store = str(tmp_path / "daily")
    status = storage.store_range(trips, "2024-01-24", store, 3)
    assert [r["status"] for r in status.collect()] == ["skipped", "processed", "processed"]
    stored = stores.load_days(spark, store)
    assert stored.select("pickup_date").distinct().count() == 2
    with pytest.raises(ValueError):
        storage.store_range(trips, "01.02.2024", store)


def test_daily_job_from_raw_files(spark, make_trips, tmp_path):
    base = make_trips([trip(), trip(pickup="2024-01-02 01:00:00")]).drop("taxi_type")
    specs = []
    for spec, extra in ((GREEN, "ehail_fee"), (YELLOW, "airport_fee")):
        raw = base.withColumnsRenamed({new: old for old, new in spec.renames.items()})
        path = str(tmp_path / spec.tag)
        raw.withColumn(extra, F.lit(1.0)).write.parquet(path)
        specs.append(replace(spec, paths=(path,)))
    store = str(tmp_path / "daily")
    storage.process_daily(spark, specs, "2024-01-01", store)
    rows = stores.load_days(spark, store)
    assert sorted(r["taxi_type"] for r in rows.collect()) == ["Green", "Yellow"]
    assert not {"ehail_fee", "airport_fee"} & set(rows.columns)
    status = storage.process_daily_range(spark, specs, "2024-01-01", store, 2)
    assert [r["trips"] for r in status.collect()] == [2, 2]
    assert stores.load_days(spark, store).count() == 4


def test_a_hot_day_is_split_over_files(spark, tmp_path):
    """Most rows on one day: rebalancing cuts the day up, and gathers the small ones."""
    hot = spark.range(400_000).select(
        F.when(F.col("id") % 10 < 9, F.lit("2024-01-05"))
        .otherwise(F.lit("2024-01-06"))
        .cast("timestamp_ntz")
        .alias("pickup_datetime"),
        F.uuid().alias("filler"),
    )
    keys = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1m",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        sinks.save_days(hot, str(tmp_path / "daily"))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(files_of(tmp_path / "daily" / "pickup_date=2024-01-05")) > 2
    assert stores.load_days(spark, str(tmp_path / "daily")).count() == 400_000


# --- weeks -----------------------------------------------------------------------


def test_weeks_hold_their_own_days(spark, trips, daily_dir, tmp_path):
    weekly = str(tmp_path / "weekly")
    weeks = storage.process_weekly(spark, daily_dir, weekly)
    assert weeks == [r["week_name"] for r in stores.list_weeks(trips).collect()]
    for week in weeks:
        stored = stores.load_week(spark, weekly, week)
        pruned = stores.days_of_week(stores.load_days(spark, daily_dir), week)
        assert sorted_rows(stored) == sorted_rows(pruned.drop("pickup_date"))
        start, _ = stores.week_range(week)
        assert stored.agg(F.min(F.to_date("pickup_datetime"))).first()[0] >= start


def test_weeks_as_tables_can_be_published_again(spark, daily_dir, tmp_path):
    weekly = str(tmp_path / "weekly")
    for _ in range(2):
        weeks = storage.process_weekly(spark, daily_dir, weekly, as_tables=True)
        total = sum(stores.load_week_table(spark, w).count() for w in weeks)
        assert total == stores.load_days(spark, daily_dir).count()


def test_publishing_one_week_leaves_the_others(spark, daily_dir, tmp_path):
    weekly = str(tmp_path / "weekly")
    weeks = storage.process_weekly(spark, daily_dir, weekly, as_tables=True)
    stamps = {p: p.stat().st_mtime_ns for p in files_of(weekly)}
    assert storage.process_weekly(spark, daily_dir, weekly, True, weeks=weeks[:1]) == weeks[:1]
    kept = {p for p in files_of(weekly) if stamps.get(p) == p.stat().st_mtime_ns}
    changed = f"week_name={weeks[0]}"
    assert kept == {p for p in stamps if changed not in str(p)} and len(kept) < len(stamps)
    assert load_counts(spark, weeks) == sum(load_counts(spark, [w]) for w in weeks)
    last = max(f.name.split("=")[1] for f in Path(daily_dir).glob("pickup_date=*"))
    assert len(storage.process_weekly(spark, daily_dir, weekly, since=last)) == 1
    assert storage.process_weekly(spark, daily_dir, weekly, weeks=["week_1_may_1999"]) is None


def test_only_weeks_with_a_changed_day_are_published_again(spark, make_trips, tmp_path):
    daily, weekly = str(tmp_path / "daily"), str(tmp_path / "weekly")
    days = ("2024-05-01", "2024-05-02", "2024-05-09", "2024-05-20")
    sinks.save_days(make_trips([trip(pickup=f"{d} 08:00:00") for d in days]), daily)

    def stamps():
        return {p: p.stat().st_mtime_ns for p in files_of(weekly)}

    def published():
        before = stamps()
        weeks = storage.process_weekly(spark, daily, weekly)
        after = stamps()
        touched = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
        return weeks, {p.parent.name.split("=")[1] for p in touched}

    names = [f"week_{n}_may_2024" for n in (1, 2, 3)]
    assert published() == (names, set(names))
    assert published() == (names, set())
    storage.store_day(make_trips([trip(pickup="2024-05-09 09:00:00")] * 3), "2024-05-09", daily)
    assert published() == (names, {names[1]})
    assert stores.load_week(spark, weekly, names[1]).count() == 3
    remove(spark, f"{daily}/pickup_date=2024-05-01")
    assert published() == (names, {names[0]})
    assert stores.load_week(spark, weekly, names[0]).count() == 1
    next(Path(weekly, f"week_name={names[2]}").glob("part-*.parquet")).unlink()
    assert published()[1] == {names[2]}
    assert stores.load_week(spark, weekly, names[2]).count() == 1
    Path(weekly, f"week_name={names[2]}", published_weeks.MANIFEST).write_text('{"days"')
    Path(weekly, f"week_name={names[2]}", f".{published_weeks.MANIFEST}.crc").unlink()
    assert published()[1] == {names[2]}


def test_weeks_without_days_go_only_when_asked(spark, make_trips, tmp_path):
    daily, weekly = str(tmp_path / "daily"), str(tmp_path / "weekly")
    rows = [trip(pickup=f"2023-06-{d} 08:00:00") for d in ("01", "09")]
    sinks.save_days(make_trips(rows), daily)
    old, kept = storage.process_weekly(spark, daily, weekly, as_tables=True)
    remove(spark, f"{daily}/pickup_date=2023-06-01")
    assert storage.process_weekly(spark, daily, weekly, as_tables=True) == [kept]
    assert stores.load_week(spark, weekly, old).count() == 1
    assert storage.process_weekly(spark, daily, weekly, as_tables=True, prune=True) == [kept]
    assert not Path(weekly, f"week_name={old}").exists()
    assert not spark.catalog.tableExists(old) and spark.catalog.tableExists(kept)


def load_counts(spark, weeks):
    return sum(stores.load_week_table(spark, w).count() for w in weeks)


def test_range_job_scans_the_raw_trips_once(spark, trips, tmp_path):
    raw = str(tmp_path / "raw")
    trips.write.parquet(raw)
    status = storage.store_range(spark.read.parquet(raw), "2024-01-24", str(tmp_path / "d"), 3)
    plan = status._jdf.queryExecution().toString()
    assert raw not in plan and str(tmp_path / "d") in plan
    assert status.agg(F.sum("trips")).first()[0] == stores.load_days(
        spark, str(tmp_path / "d")
    ).count()


def test_a_closed_run_leaves_no_facts(trips, tmp_path):
    with metrics_job.prepare(trips) as run:
        assert run.cleaning().count() == 1
        assert Path(run.facts_dir).exists()
    assert not Path(run.facts_dir).exists()


def test_week_tables_answer_sql(spark, daily_dir, tmp_path):
    storage.process_weekly(spark, daily_dir, str(tmp_path / "weekly"), as_tables=True)
    counts = spark.sql(f"""SELECT pickup_datetime::date AS date, taxi_type, count(*) AS trips
        FROM {WEEK} GROUP BY 1, 2 ORDER BY 1, 2""")
    table = stores.load_week_table(spark, WEEK)
    expected = metrics.count_by_day_and_type(table)
    assert counts.selectExpr("date::string", "taxi_type", "trips").collect() == expected.collect()
    assert counts.count() >= 14


def test_single_week_takes_the_first_name(spark, daily_dir, tmp_path):
    weekly = str(tmp_path / "weekly")
    assert storage.process_weekly(spark, daily_dir, weekly, single_week=True) == [
        "week_4_january_2024"
    ]
    assert spark.read.parquet(weekly).count() == stores.load_days(spark, daily_dir).count()


def test_no_days_no_weeks(spark, tmp_path):
    assert storage.process_weekly(spark, str(tmp_path / "none"), str(tmp_path / "weekly")) is None
    assert not (tmp_path / "weekly").exists()


def test_week_table_is_replaced(spark, make_trips, tmp_path):
    for n in (3, 2):
        sinks.save_week_table(make_trips([trip()] * n), "week_1_replaced_2024", str(tmp_path / "t"))
        assert stores.load_week_table(spark, "week_1_replaced_2024").count() == n


# --- metrics and report ----------------------------------------------------------


def test_week_job_writes_the_five_files(spark, daily_dir, tmp_path):
    weekly, out = str(tmp_path / "weekly"), str(tmp_path / "output")
    storage.process_weekly(spark, daily_dir, weekly)
    run = metrics_job.run_week(spark, WEEK, out, weekly)
    names = sorted(p.name for p in (tmp_path / "output" / WEEK).iterdir())
    assert names == [
        "2024_02_week2_anomaly_monitoring.csv",
        "2024_02_week2_daily_avg_metrics.csv",
        "2024_02_week2_peak_hour_per_day.csv",
        "2024_02_week2_revenue_per_day.csv",
        "2024_02_week2_trips_per_day.csv",
    ]
    for slug, table in run.tables.items():
        read = read_week_metric(spark, out, WEEK, slug)
        assert read.dtypes == table.dtypes
        assert read.collect() == metrics.in_order(table).collect()
    report = report_job.report_week(spark, out, WEEK)
    (row,) = as_dicts(report.kpis)
    per_day = run.tables["trips_per_day"]
    assert row["total_trips"] == per_day.agg(F.sum("total_trips")).first()[0]
    assert row["total_trips"] <= run.cleaning().first()["final_rows"]
    assert report.breakdown.count() == row["num_days"] == 7
    assert report.busiest.count() == 3


def test_csv_content(make_trips, tmp_path):
    rows = [trip(total=30_000_000.0)] * 2 + [trip(pickup="2024-01-02 08:00:00", passengers=3.0)]
    metrics_job.run_trips(make_trips(rows), "week_1_january_2024", str(tmp_path))
    folder = tmp_path / "week_1_january_2024"
    (revenue,) = files_of(folder / "2024_01_week1_revenue_per_day.csv")
    assert revenue.suffix == ".csv"
    assert revenue.read_text().splitlines() == [
        "date,taxi_type,total_revenue_per_day",
        "2024-01-01,Green,60000000.00",
        "2024-01-02,Green,10.00",
    ]
    (flags,) = files_of(folder / "2024_01_week1_anomaly_monitoring.csv")
    assert [line.split(",")[-1] for line in flags.read_text().splitlines()] == [
        "is_anomaly",
        "False",
        "True",
    ]


def test_infinite_amounts_survive_the_files(spark, make_trips, tmp_path):
    week = "week_1_january_2024"
    metrics_job.run_trips(make_trips([trip(total=float("inf")), trip()]), week, str(tmp_path))
    read = read_week_metric(spark, str(tmp_path), week, "revenue_per_day")
    assert read.first()["total_revenue_per_day"] == float("inf")


def test_all_weeks_equal_the_single_weeks(spark, trips, daily_dir, tmp_path):
    weekly, out = str(tmp_path / "weekly"), str(tmp_path / "out")
    weeks = storage.process_weekly(spark, daily_dir, weekly)
    metrics_job.run_all_weeks(trips, out)
    together = {r["week_name"]: r for r in as_dicts(report_job.report_all_weeks(spark, out).kpis)}
    assert sorted(together) == weeks
    for week in weeks[:2]:
        metrics_job.run_week(spark, week, out, weekly)
        (alone,) = as_dicts(report_job.report_week(spark, out, week).kpis)
        assert alone == together[week]


def fail_once(batches):
    """Passes rows on and then fails, on the first attempt of every other task."""
    yield from batches
    context = TaskContext.get()
    if context.attemptNumber() == 0 and context.partitionId() % 2:
        raise RuntimeError("lost")


def test_tasks_that_run_twice_count_once(spark, trips, tmp_path):
    steady = trips.repartition(4)
    flaky = steady.mapInArrow(fail_once, trips.schema)
    once, again = (metrics_job.prepare(t, by_week=True) for t in (steady, flaky))
    assert once.cleaning().first() == again.cleaning().first()
    for slug, table in once.tables.items():
        assert sorted_rows(table) == sorted_rows(again.tables[slug])
    sinks.save_days(flaky, str(tmp_path / "daily"))
    stored = stores.load_days(spark, str(tmp_path / "daily"))
    assert stored.count() == trips.filter("pickup_datetime is not null").count()


def test_the_job_scans_the_trips_once(spark, trips, capsys):
    """Metric tables read the written facts, not the trips."""
    run = metrics_job.prepare(trips, by_week=True)
    for table in run.tables.values():
        table.explain("formatted")
    plans = capsys.readouterr().out
    assert "ExistingRDD" not in plans and "LocalTableScan" not in plans
    assert "/facts-" in plans


def test_custom_metrics_and_selection(trips, tmp_path):
    longest = registry.Metric(
        "Longest Trip", "longest_trip", lambda t: t.agg(F.max("trip_distance").alias("miles"))
    )
    chosen = registry.default_registry(MetricsConfig(enabled=("trips_per_day",))).register(longest)
    run = metrics_job.run_trips(trips, "custom", str(tmp_path), registry=chosen)
    assert list(run.tables) == ["trips_per_day", "longest_trip"]
    assert sorted(p.name for p in (tmp_path / "custom").iterdir()) == [
        "custom_longest_trip.csv",
        "custom_trips_per_day.csv",
    ]
    metrics_job.run_all_weeks(trips, str(tmp_path / "all"), registry=chosen)
    assert (tmp_path / "all" / "longest_trip").is_dir()
    with pytest.raises(AggregationError, match="unknown metrics"):
        registry.default_registry(MetricsConfig(enabled=("nope",)))


def test_first_failing_metric_ends_the_run(trips):
    broken = registry.Metric("Broken", "broken", lambda t: t.select("no_such_column"))
    with pytest.raises(AggregationError, match="Broken"):
        registry.MetricRegistry([broken]).compute_all(trips)


def test_registry_without_written_facts(trips):
    timed = with_duration(trips)
    tables = registry.default_registry().compute_all(timed, WEEK)
    assert tables["Trips Per Day"][1] == "2024_02_week2_trips_per_day.csv"
    direct = metrics.in_order(metrics.trips_per_day(daily_facts(timed)))
    assert tables["Trips Per Day"][0].collect() == direct.collect()


# --- session ---------------------------------------------------------------------


def test_shared_dir_follows_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(root) and first != second


def test_only_a_local_master_may_lack_a_shared_folder():
    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: default),
            sparkContext=SimpleNamespace(master=master),
        )

    assert shared_dir(session("local[2]"), "x").rsplit("/", 1)[1].startswith("x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"), "x")


def test_at_once_keeps_order_and_raises(spark):
    assert at_once(spark, [partial(spark.range(n).count) for n in (3, 1, 2)]) == [3, 1, 2]
    assert at_once(spark, []) == []
    with pytest.raises(ZeroDivisionError):
        at_once(spark, [lambda: 1 // 0])
