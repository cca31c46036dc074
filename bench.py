"""Time the headline queries and print one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. All queries run
once to warm the JVM up, and then three rounds are timed; the middle time of a query
counts. Results are fetched in full. After that the jobs run once each over the events
repeated $BENCH_TIMES times (200 make 20 million rows at the default scale), with the rows
per second and the shuffled bytes, taken from Spark's event log.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from pyspark.sql import functions as F

from tripweave.plans.metrics_job import run_all_weeks, run_trips
from tripweave.plans.report_job import report_all_weeks
from tripweave.plans.storage import process_weekly, store_range
from tripweave.queries import QUERIES, whole_range
from tripweave.session import build_session, shared_dir
from tripweave.sources.fleets import GREEN, YELLOW, combine
from tripweave.sources.folders import remove
from tripweave.sources.sample_tables import (
    event_trips,
    events_as_trips,
    lineitem_trips,
    raw_fleets,
    table,
)

HEADLINE = (
    "trips_per_day",
    "revenue_per_day",
    "hourly_trips",
    "daily_avg_metrics",
    "anomaly_monitoring",
    "trips_per_day_lines",
    "revenue_per_day_lines",
    "hourly_trips_lines",
    "daily_avg_metrics_lines",
    "anomaly_monitoring_lines",
    "weekly_by_type",
    "executive_summary_lines",
    "normalized_union",
    "stream_window_counts",
)
ROUNDS = 3


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    log_dir = tempfile.mkdtemp(prefix="bench-events-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{log_dir}",
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The metrics jobs load, derive, clean, compute five metrics and write them as CSV.
    jobs = {
        "store_days": lambda: store_days(spark, sf_dir),
        "publish_weeks": lambda: process_weekly(spark, stored, shared_dir(spark, "bench"), True),
        "metrics_job_lines": lambda: run_trips(
            lineitem_trips(spark, sf_dir), "order_lines", shared_dir(spark, "bench")
        ).close(),
        "metrics_and_report_job": lambda: metrics_and_report(spark, sf_dir),
    }
    stored = store_days(spark, sf_dir)
    runs = {n: lambda q=QUERIES[n]: q(spark, sf_dir).toArrow() for n in HEADLINE} | jobs
    rounds = [{name: timed(run) for name, run in runs.items()} for _ in range(ROUNDS + 1)][1:]
    seconds = {n: round(statistics.median(r[n] for r in rounds), 3) for n in runs}
    rows = table(spark, sf_dir, "lineitem").count()
    scale = at_scale(spark, sf_dir, int(os.environ.get("BENCH_TIMES", "200")))
    spark.stop()
    for job in scale["jobs"].values():
        job["shuffle_mb"] = round(shuffled(log_dir, job.pop("from"), job.pop("to")) / 1e6, 1)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
                "metrics_job_rows_per_sec": round(rows / seconds["metrics_job_lines"]),
                "scale": scale,
            }
        )
    )


def at_scale(spark, sf_dir: str, times: int) -> dict:
    """The jobs over many copies of the events, once each."""
    root = shared_dir(spark, "bench-scale")
    copies = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    events = table(spark, sf_dir, "events").withColumn("copy", copies)
    events = events.withColumn("event_id", F.col("event_id") * times + F.col("copy")).drop("copy")
    events.repartition(16).write.parquet(f"{root}/events")
    trips = events_as_trips(spark.read.parquet(f"{root}/events"))
    rows, (start, num_days) = trips.count(), whole_range(trips)
    days = f"{root}/days"
    jobs = {
        "metrics_job": lambda: run_trips(trips, "events", f"{root}/metrics").close(),
        "range_job": lambda: store_range(trips, start, days, num_days).collect(),
        "publish": lambda: process_weekly(spark, days, f"{root}/weeks"),
    }
    found = {}
    for name, job in jobs.items():
        began = time.time()
        seconds = timed(job)
        found[name] = {
            "sec": round(seconds, 2),
            "rows_per_sec": round(rows / seconds),
            "from": began * 1000,
            "to": time.time() * 1000,
        }
    remove(spark, root)
    return {"rows": rows, "jobs": found}


def shuffled(log_dir: str, start: float, end: float) -> int:
    """Bytes that tasks launched between two times (ms) wrote for shuffles."""
    total = 0
    for path in Path(log_dir).iterdir():
        for line in path.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                if start <= event["Task Info"]["Launch Time"] <= end:
                    written = event.get("Task Metrics", {}).get("Shuffle Write Metrics", {})
                    total += written.get("Shuffle Bytes Written", 0)
    return total


def store_days(spark, sf_dir: str) -> str:
    """Two raw sources to one store of days."""
    store = shared_dir(spark, "bench")
    green, yellow = raw_fleets(spark, sf_dir)
    trips = combine([GREEN.normalize(green), YELLOW.normalize(yellow)])
    start, num_days = whole_range(trips)
    store_range(trips, start, store, num_days)
    return store


def metrics_and_report(spark, sf_dir: str) -> None:
    out = shared_dir(spark, "bench")
    run_all_weeks(event_trips(spark, sf_dir), out).close()
    report_all_weeks(spark, out).kpis.collect()


if __name__ == "__main__":
    main()
