"""Trips and revenue in short event-time windows, as files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripweave.contracts import STREAM_LATENESS, STREAM_WINDOW, DataValidationError
from tripweave.functions.numbers import (
    SUM_STATE,
    exact_sum,
    known,
    round2,
    sum_from_state,
    total_of,
)

#: Batches whose figures a query keeps, more than can pass between two looks at them.
KEPT_BATCHES = 10_000
KEPT_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"
POLL_SECONDS = 5


def stream_parquet(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    file_glob: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream over the Parquet files that appear in a folder.

    All files that are there at a trigger form one batch. A cap on the files of a batch makes
    their order matter: files come by age and not by event time, and rows behind the
    watermark of an earlier batch are late. `write_windows` counts those.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def window_counts(
    trips: DataFrame, window: str = STREAM_WINDOW, lateness: str = STREAM_LATENESS
) -> DataFrame:
    """(window_start, window_end, taxi_type, trips, revenue) of tumbling windows.

    Watermarks need a zoned timestamp, so the local pickup time is read in the session
    zone and turned back on output; run the stream with the session in UTC. State holds
    one row per type and open window. On a batch frame the watermark has no effect and
    all windows come out.
    """
    timed = trips.withColumn("at", F.col("pickup_datetime").cast("timestamp"))
    counted = (
        timed.withWatermark("at", lateness)
        .groupBy(F.window("at", window).alias("w"), "taxi_type")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            exact_sum(known(trips, "total_amount").cast("double")).alias("revenue"),
        )
    )
    return _reported(counted)


def _reported(counted: DataFrame) -> DataFrame:
    return counted.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "taxi_type",
        "trips",
        round2(total_of(F.col("revenue"))).alias("revenue"),
    )


def open_windows(spark: SparkSession, checkpoint_dir: str) -> DataFrame:
    """The windows that a stream of `window_counts` has not closed yet, with what is in them.

    Read from the state at its last checkpoint, while the stream does not run.
    """
    state = spark.read.format("statestore").load(checkpoint_dir)
    held = state.select(
        F.col("key").cast("struct<w:struct<start:timestamp,end:timestamp>,taxi_type:string>").alias("k"),
        F.col("value").cast(f"struct<trips:bigint,{SUM_STATE}>").alias("v"),
    )
    return _reported(
        held.select("k.w", "k.taxi_type", "v.trips", sum_from_state(F.col("v")).alias("revenue"))
    )


def all_windows(spark: SparkSession, output_dir: str, checkpoint_dir: str) -> DataFrame:
    """Closed windows from the sink and open ones from the state, each window once."""
    still = open_windows(spark, checkpoint_dir)
    return spark.read.schema(still.schema).parquet(output_dir).unionByName(still)


def _run_to_end(query: StreamingQuery) -> int:
    """Waits for the end of a query; the rows that its batches dropped as too late.

    Looked up while the query runs, as it keeps the figures of some batches only. A batch
    whose figures are missing is an error.
    """
    late: dict[int, int] = {}
    while True:
        ended = query.awaitTermination(POLL_SECONDS)
        for progress in query.recentProgress:
            dropped = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
            late[progress.batchId] = max(dropped, late.get(progress.batchId, 0))
        if ended:
            break
    if late and len(late) != max(late) - min(late) + 1:
        raise DataValidationError("the figures of some batches were lost; late rows are unknown")
    return sum(late.values())


def write_windows(
    counts: DataFrame, output_dir: str, checkpoint_dir: str, fail_on_late: bool = False
) -> int:
    """Append closed windows to Parquet, each once, until the input is used up.

    Returns the number of rows (per window and type) that came too late for their window;
    with ``fail_on_late`` any such row is an error.
    """
    spark = counts.sparkSession
    before = spark.conf.get(KEPT_PROGRESS)
    spark.conf.set(KEPT_PROGRESS, str(max(KEPT_BATCHES, int(before))))
    try:
        query: StreamingQuery = (
            counts.writeStream.outputMode("append")
            .format("parquet")
            .option("path", output_dir)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(KEPT_PROGRESS, before)
    late = _run_to_end(query)
    if late and fail_on_late:
        raise DataValidationError(f"{late} rows came after their window was closed")
    return late
