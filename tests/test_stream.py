"""Windowed counts over arriving files."""

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import TRIP_DDL, at, trip
from tripweave.contracts import DataValidationError
from tripweave.streaming import windows
from tripweave.streaming.windows import stream_parquet, window_counts, write_windows


def run(spark, source, out, state):
    schema = spark.createDataFrame([], TRIP_DDL).schema
    counts = window_counts(stream_parquet(spark, str(source), schema))
    write_windows(counts, str(out), str(state))
    rows = spark.read.parquet(str(out)).collect()
    return {(r["window_start"], r["taxi_type"]): (r["trips"], r["revenue"]) for r in rows}


def drop_file(make_trips, folder, rows):
    make_trips(rows).coalesce(1).write.mode("append").parquet(str(folder))


def test_windows_close_once_and_late_rows_are_dropped(spark, make_trips, tmp_path):
    source, out, state = (tmp_path / n for n in ("in", "out", "state"))
    first = [
        trip(pickup="2024-01-01 08:00:00", total=1.25),
        trip(pickup="2024-01-01 08:04:59.999999", total=2.0),
        trip(pickup="2024-01-01 08:05:00", total=4.0),
        trip(pickup="2024-01-01 08:01:00", total=float("nan")),
        trip(pickup="2024-01-01 08:01:00", kind="Yellow", total=8.0),
    ]
    drop_file(make_trips, source, first)
    assert run(spark, source, out, state) == {} if out.exists() else True
    drop_file(make_trips, source, [trip(pickup="2024-01-01 08:20:00")])
    eight = at("2024-01-01 08:00:00")
    expected = {
        (eight, "Green"): (3, 3.25),
        (eight, "Yellow"): (1, 8.0),
        (eight + timedelta(minutes=5), "Green"): (1, 4.0),
    }
    assert run(spark, source, out, state) == expected
    late = [trip(pickup="2024-01-01 08:02:00"), trip(pickup="2024-01-01 08:13:00", total=5.0)]
    drop_file(make_trips, source, late)
    drop_file(make_trips, source, [trip(pickup="2024-01-01 09:00:00")])
    found = run(spark, source, out, state)
    assert {k: found[k] for k in expected} == expected
    assert found[eight + timedelta(minutes=10), "Green"] == (1, 5.0)
    assert found[eight + timedelta(minutes=20), "Green"] == (1, 10.0)
    assert len(found) == 5


def test_old_files_in_any_order_lose_nothing(spark, make_trips, tmp_path):
    source, schema = tmp_path / "in", spark.createDataFrame([], TRIP_DDL).schema
    for day in (20, 25, 1, 2):
        rows = [trip(pickup=f"2024-01-{day:02d} 08:{m:02d}:00") for m in range(0, 60, 2)]
        drop_file(make_trips, source, rows)

    def written(name, **options):
        counts = window_counts(stream_parquet(spark, str(source), schema, **options))
        late = write_windows(counts, str(tmp_path / name), str(tmp_path / f"{name}-state"))
        out = spark.read.parquet(str(tmp_path / name))
        return late, sorted(map(tuple, out.drop("revenue").collect()))

    late, found = written("all")
    closed = window_counts(spark.read.parquet(str(source))).filter(
        "window_end <= timestamp_ntz '2024-01-25 08:48:00'"
    )
    assert late == 0 and found == sorted(map(tuple, closed.drop("revenue").collect()))
    late, found = written("capped", files_per_batch=1)
    assert late > 0 and sum(r[3] for r in found) < 100


def test_late_rows_are_counted_and_can_be_an_error(spark, make_trips, tmp_path):
    source, schema = tmp_path / "in", spark.createDataFrame([], TRIP_DDL).schema
    places = str(tmp_path / "out"), str(tmp_path / "state")
    drop_file(make_trips, source, [trip(pickup="2024-01-02 08:00:00")])
    counts = window_counts(stream_parquet(spark, str(source), schema))
    assert write_windows(counts, *places) == 0
    drop_file(make_trips, source, [trip(), trip(kind="Yellow"), trip(pickup="2024-01-02 09:00:00")])
    with pytest.raises(DataValidationError, match="2 rows"):
        write_windows(counts, *places, fail_on_late=True)


def test_late_rows_of_many_batches_are_all_counted(spark, make_trips, tmp_path):
    """More batches than a query keeps figures of by default, late rows among the first."""
    source, schema = tmp_path / "in", spark.createDataFrame([], TRIP_DDL).schema
    source.mkdir()

    def add(k, pickup):
        one = tmp_path / f"one{k}"
        make_trips([trip(pickup=pickup)]).coalesce(1).write.parquet(str(one))
        part = next(one.glob("part-*.parquet"))
        place = source / f"f{k:03d}.parquet"
        place.write_bytes(part.read_bytes())
        os.utime(place, (1_700_000_000 + k, 1_700_000_000 + k))

    add(0, "2024-01-02 08:00:00")
    for k in range(1, 112):
        add(k, "2024-01-01 08:00:00" if k in (3, 5, 7, 9) else f"2024-01-02 08:{k % 60:02d}:00")
    before = spark.conf.get(windows.KEPT_PROGRESS)

    def run(name):
        counts = window_counts(stream_parquet(spark, str(source), schema, files_per_batch=1), lateness="2 hours")
        return write_windows(counts, str(tmp_path / name), str(tmp_path / f"{name}-state"))

    assert run("a") == 4 and run("a") == 0
    add(200, "2024-01-01 09:00:00")  # after a restart from the checkpoint
    assert run("a") == 1
    assert spark.conf.get(windows.KEPT_PROGRESS) == before
    found = windows.all_windows(spark, str(tmp_path / "a"), str(tmp_path / "a-state"))
    assert found.agg(F.sum("trips")).first()[0] == 108


def test_open_and_closed_windows_are_all(spark, make_trips, tmp_path):
    source, schema = tmp_path / "in", spark.createDataFrame([], TRIP_DDL).schema
    rows = [trip(pickup=f"2024-01-01 08:{m:02d}:00", total=m + 0.1, kind="GY"[m % 2]) for m in range(60)]
    rows += [trip(pickup="2024-01-01 08:59:30", total=5e6), trip(pickup="2024-01-01 08:59:31", total=float("inf"))]
    drop_file(make_trips, source, rows)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream = window_counts(stream_parquet(spark, str(source), schema))
    assert write_windows(stream, out, state) == 0
    expected = sorted(map(tuple, window_counts(spark.read.parquet(str(source))).collect()))
    closed = sorted(map(tuple, spark.read.parquet(out).collect()))
    still = sorted(map(tuple, windows.open_windows(spark, state).collect()))
    assert sorted(closed + still) == expected and closed and still
    drop_file(make_trips, source, [trip(pickup="2024-01-01 08:58:00", kind="G"), trip(pickup="2024-01-01 10:00:00")])
    assert write_windows(stream, out, state) == 0
    expected = sorted(map(tuple, window_counts(spark.read.parquet(str(source))).collect()))
    assert sorted(map(tuple, windows.all_windows(spark, out, state).collect())) == expected


def test_batch_frames_give_all_windows(make_trips):
    rows = [trip(pickup=f"2024-01-01 08:{m:02d}:00") for m in range(0, 30, 2)]
    counts = window_counts(make_trips(rows))
    assert counts.count() == 6
    assert counts.agg(F.sum("trips")).first()[0] == 15
