"""Connected components of a link table that stays distributed.

Alternates the large-star and small-star steps of Kiveris et al. (2014): each step hangs the
neighbours of a node on the smallest of them. Minima are partial aggregates and come back by
a join, so the links of a hub are never gathered in one task. Each round is written to the
shared folder; the driver sees counts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.frames import saved


#: Links that one task of a round writes, about; a round has a task per core at least.
TASK_LINKS = 100_000


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step over links (a, b) with a > b; returns distinct links of that form."""
    swapped = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    pairs = links.unionByName(swapped) if large else links
    least = pairs.groupBy("a").agg(F.min("b").alias("low")).withColumn(
        "low", F.least("low", "a")
    )
    near = pairs.join(least.withColumnRenamed("a", "hub"), F.col("a") == F.col("hub"))
    if large:
        moved = near.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), "low")
    else:
        moved = near.select(F.col("b").alias("a"), "low").unionByName(near.select("a", "low"))
    return (
        moved.filter(F.col("a") != F.col("low")).select("a", F.col("low").alias("b")).distinct()
    )


def _state(links: DataFrame):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 1_000_003))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes in ``links`` (a, b: long, a > b) that are not roots.

    The root of a component is its smallest node.
    """
    links = saved(links.distinct(), "links")
    state = _state(links).first()
    cores = links.sparkSession.sparkContext.defaultParallelism
    while state[0]:
        # Few links in many partitions would be as many files, each read again in the next round.
        n_tasks = max(cores, -(-state[0] // TASK_LINKS))
        links = saved(_star(_star(links, large=True), large=False).coalesce(n_tasks), "links")
        before, state = state, _state(links).first()
        if before == state:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
