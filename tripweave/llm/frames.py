"""Helpers that the operators share: names, intermediate tables, slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.session import shared_dir

#: What separates words in the whole subpackage: space, tab, line feed, VT, FF, carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until no column of ``df`` has the name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


#: Lets Spark delete the shuffle files of an execution when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``saved``, with the path of the table for a caller that removes it."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Ends the lineage: a lost executor recomputes from the written table, and the shuffle files
    behind it, of no more use, are deleted at once. So the disk use of a job with many steps
    stays near that of its largest step.
    """
    return saved_at(df, label)[0]


#: Bounds the Arrow batches that go to Python by their bytes.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Batches of texts go to Python in some megabytes, unless the session has a bound of its own.

    By rows alone, 10,000 texts make a batch, which is in the JVM and in Python several times.
    """
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(BATCH_BYTES))


#: A key is heavy if it has more than one in so many of all rows; fewer keys than that can be.
HEAVY = 1_000


def looked_up(rows: DataFrame, key: str, names: DataFrame, total: int) -> DataFrame:
    """The ``total`` rows joined with ``names``: each key once, ``n`` its number of rows.

    Heavy keys go out to all tasks and their rows stay where they are, so that none of them
    fills a task; the others meet through a shuffle.
    """
    heavy = F.col("n") * HEAVY > total
    common = F.broadcast(names.filter(heavy))
    here = rows.join(common, key)
    rest = rows.join(common.select(key), key, "left_anti").join(names.filter(~heavy), key)
    return here.unionByName(rest).drop("n")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    start, data = column.offset, column.buffers()[2]
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[start : start + len(column) + 1]
    buffer = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return buffer[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``limit`` bytes together; a longer row stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last
