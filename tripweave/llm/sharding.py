"""Shards of near equal bytes over a fixed number of virtual slots.

A record belongs to the slot that the hash of its key columns gives; the number of slots never
changes. A map from slots to shards says where records are. It is a small table (one row per
slot) of which every version is kept: `first_map` deals the slots out evenly, `rebalanced`
edits a map by the bytes that each slot holds, `grown` edits it for one shard more, which
takes slots only into itself. `write_shards` writes records as files of their shard, and
`read_shards` numbers them within it by file and row, so that nothing is sorted.

Everything is built-in functions. Records are reduced to bytes per slot before anything is
shuffled, and only the map, with its fixed number of rows, is broadcast. While shards are
written, a large shard is split over tasks.

Defined results: null keys have a hash like any other; a null size counts as zero; rows with
equal keys share a slot, so key columns that tell rows apart (an id and its text) balance
best; repeated rows are separate rows; all columns are kept and added ones get other names if
theirs are taken; an empty table gives the first map and shards without rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.functions.numbers import exact
from tripweave.llm.frames import free_name, saved

#: Virtual slots, for good.
SLOTS = 4096


def slot_of(keys: Sequence[str], slots: int = SLOTS) -> Column:
    """The virtual slot of a record."""
    return F.pmod(F.xxhash64(*map(exact, keys)), F.lit(slots)).cast("int")


def slot_loads(records: DataFrame, keys: Sequence[str], size: str, slots: int = SLOTS) -> DataFrame:
    """(slot, n_bytes, n_rows) of the slots that hold records."""
    return records.groupBy(slot_of(keys, slots).alias("slot")).agg(
        F.sum(F.coalesce(exact(size), F.lit(0)).cast("long")).alias("n_bytes"),
        F.count(F.lit(1)).alias("n_rows"),
    )


# --- the map and its versions ----------------------------------------------------


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """(slot, shard): slots dealt out in turn."""
    return spark.range(slots).select(
        F.col("id").cast("int").alias("slot"), (F.col("id") % shards).cast("int").alias("shard")
    )


def _heaped(slot_map: DataFrame, loads: DataFrame) -> DataFrame:
    """The map with bytes and, from each shard's largest slot on, the bytes so far."""
    known = slot_map.join(loads.select("slot", "n_bytes"), "slot", "left").withColumn(
        "n_bytes", F.coalesce("n_bytes", F.lit(0))
    )
    largest_first = Window.partitionBy("shard").orderBy(F.desc("n_bytes"), "slot")
    return known.withColumn("heap", F.sum("n_bytes").over(largest_first)).withColumn(
        "total", F.sum("n_bytes").over(Window.partitionBy())
    )


def _stays(shards: int) -> Column:
    return (F.col("heap") * shards <= F.col("total")) | (F.col("n_bytes") == 0)


def rebalanced(slot_map: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """An edited map: what a shard holds above its share moves to the emptiest shards.

    Each shard keeps its largest slots up to an equal share of all bytes. The other slots go,
    largest first, to whichever shard holds least by then.
    """
    heaped = _heaped(slot_map, loads).withColumn("stays", _stays(shards))
    loose = F.array_sort(
        F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("n_bytes")).alias("b"), "slot")))
    )
    held = [
        F.sum(F.when(F.col("stays") & (F.col("shard") == k), F.col("n_bytes")).otherwise(0))
        for k in range(shards)
    ]
    start = F.struct(
        F.col("held"), F.array().cast("array<struct<slot:int,shard:int>>").alias("moved")
    )

    def place(state: Column, slot: Column) -> Column:
        least = F.array_position(state["held"], F.array_min(state["held"])) - 1
        held_now = F.transform(
            state["held"], lambda x, k: F.when(k == least, x - slot["b"]).otherwise(x)
        )
        put = F.struct(slot["slot"].alias("slot"), least.cast("int").alias("shard"))
        return F.struct(
            held_now.alias("held"), F.concat(state["moved"], F.array(put)).alias("moved")
        )

    moved = (
        heaped.agg(loose.alias("loose"), F.array(*held).alias("held"))
        .select(F.aggregate("loose", start, place)["moved"].alias("moved"))
        .select(F.inline("moved"))
    )
    return heaped.filter("stays").select("slot", "shard").unionByName(moved)


def grown(slot_map: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """An edited map with shard number ``shards`` added, which gets what the others hold above
    their new share; no slot moves between old shards."""
    heaped = _heaped(slot_map, loads)
    return heaped.select(
        "slot", F.when(_stays(shards + 1), F.col("shard")).otherwise(F.lit(shards)).alias("shard")
    )


def save_map(slot_map: DataFrame, path: str, version: int) -> DataFrame:
    """Writes one version of the map; a version that is there already is an error."""
    target = f"{path}/version={version}"
    slot_map.select("slot", "shard").coalesce(1).write.mode("error").parquet(target)
    return load_map(slot_map.sparkSession, path, version)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(slot, shard) of a version, the latest if none is named."""
    maps = spark.read.schema("slot int, shard int, version int").parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == version).select("slot", "shard")


def moves(before: DataFrame, after: DataFrame) -> DataFrame:
    """(slot, from_shard, to_shard) of the slots that two maps place differently."""
    a = before.select("slot", F.col("shard").alias("from_shard"))
    b = after.select("slot", F.col("shard").alias("to_shard"))
    return a.join(b, "slot").filter("from_shard <> to_shard")


# --- records ---------------------------------------------------------------------


def placed(
    records: DataFrame,
    slot_map: DataFrame,
    keys: Sequence[str],
    slots: int = SLOTS,
    name: str = "shard",
) -> DataFrame:
    """``records`` with the number of their shard."""
    at, where = free_name(records, "_slot"), free_name(records, name)
    small = F.broadcast(slot_map.select(F.col("slot").alias(at), F.col("shard").alias(where)))
    kept = [exact(c) for c in records.columns]
    return records.withColumn(at, slot_of(keys, slots)).join(small, at).select(*kept, where)


def write_shards(
    records: DataFrame, slot_map: DataFrame, keys: Sequence[str], path: str, slots: int = SLOTS
) -> None:
    """Writes the records below ``path``, each shard in a folder of its own."""
    where = free_name(records, "shard")
    rows = placed(records, slot_map, keys, slots, where)
    balanced = rows.hint("rebalance", where)
    balanced.write.option("compression", "zstd").partitionBy(where).parquet(path)


def read_shards(records: DataFrame, path: str) -> DataFrame:
    """What ``write_shards`` wrote of ``records``: their columns, the shard, and the place
    within it, from 0 on without a gap.

    A row's place is its number in its file, behind all rows of the shard's earlier files.
    """
    spark = records.sparkSession
    where = free_name(records, "shard")
    schema = T.StructType([*records.schema.fields, T.StructField(where, T.IntegerType())])
    rows = spark.read.schema(schema).parquet(path)
    about = rows.metadataColumn("_metadata")
    file, row, place = (free_name(rows, c) for c in ("_file", "_row", "slot"))
    found = rows.withColumn(file, about["file_path"]).withColumn(row, about["row_index"])
    in_order = Window.partitionBy(where).orderBy(file)
    # a table of its own, whose size Spark knows when it plans the join
    files = saved(
        found.groupBy(where, file)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(file, (F.sum("n").over(in_order) - F.col("n")).alias("before")),
        "shard-files",
    )
    kept = [exact(c) for c in rows.columns]
    joined = found.join(files, file)
    return joined.select(*kept, (F.col("before") + F.col(row)).alias(place))
