"""Trip views over the benchmark tables, which hold no trips of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_as_trips(events: DataFrame) -> DataFrame:
    """Events as short trips at all hours of the day. Works on a stream as well."""
    n, value, kind = F.col("event_id"), F.col("value"), F.col("event_type")
    minutes = (F.lit(1) + n % 60).cast("int")
    passengers = (
        F.when(n % 101 == 0, F.lit(None).cast("double"))
        .when(n % 9 == 0, F.lit(0.0))
        .when(n % 11 == 0, F.lit(7.0))
        .otherwise((F.lit(1) + n % 2).cast("double"))
    )
    return events.select(
        n.alias("VendorID"),
        F.col("ts").alias("pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0))).alias(
            "dropoff_datetime"
        ),
        passengers.alias("passenger_count"),
        (value / F.lit(10.0) - F.lit(0.05)).alias("trip_distance"),
        (value * F.lit(0.8)).alias("fare_amount"),
        (value - F.lit(0.5)).alias("total_amount"),
        F.when(kind.isin("click", "error"), F.lit("Green")).otherwise(F.lit("Yellow")).alias(
            "taxi_type"
        ),
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_trips(table(spark, sf_dir, "events"))


def lineitem_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as long trips from order date to ship date, by the day."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    fare = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("l_orderkey").alias("VendorID"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        fare.alias("fare_amount"),
        (fare * (F.lit(1) + F.col("l_tax"))).alias("total_amount"),
        F.col("l_returnflag").alias("taxi_type"),
    )


def raw_fleets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The event trips split back into two sources with differing schemas."""
    trips = event_trips(spark, sf_dir)
    times = ("pickup_datetime", "dropoff_datetime")
    green = (
        trips.filter(F.col("taxi_type") == "Green")
        .drop("taxi_type")
        .withColumnsRenamed({c: f"lpep_{c}" for c in times})
        .withColumns({"ehail_fee": F.lit(0.0), "Airport_fee": F.lit(1.25)})
    )
    yellow = (
        trips.filter(F.col("taxi_type") == "Yellow")
        .drop("taxi_type")
        .withColumnsRenamed({c: f"tpep_{c}" for c in times})
        .withColumns({"airport_fee": F.lit(1.25)})
    )
    return green, yellow
