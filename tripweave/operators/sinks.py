"""Writers. Each one replaces exactly what it names, so a rerun changes nothing."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.contracts import JDBC_BATCH_ROWS, METRIC_KEYS, METRIC_SCHEMAS
from tripweave.functions.weeks import metric_file_name, week_name
from tripweave.operators.metrics import in_order
from tripweave.sources.schemas import note_schema

_MONEY = ("total_revenue_per_day", "avg_fare_amount", "avg_total_amount")


def _replace_folders(
    df: DataFrame, path: str, key: str, rebalance: bool, one_value: bool = False
) -> None:
    """Write one folder per key value; folders of other values stay.

    Rebalancing costs a shuffle and saves the many small files of every task writing to
    every folder. It gathers rows by key, yet splits a key that holds most of them; with
    one value of the key there is nothing to gather by.
    """
    note_schema(df.sparkSession, path, key, df.schema)
    if rebalance:
        df = df.hint("rebalance") if one_value else df.hint("rebalance", key)
    (
        df
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )


def save_days(
    trips: DataFrame, daily_dir: str, rebalance: bool = True, one_day: bool = False
) -> None:
    """Replace the stored days that occur in `trips`; no rows means no change.

    Input that is ordered by time already may go without the rebalance.
    """
    dated = trips.filter(F.col("pickup_datetime").isNotNull()).withColumn(
        "pickup_date", F.to_date("pickup_datetime")
    )
    _replace_folders(dated, daily_dir, "pickup_date", rebalance, one_day)


def save_weeks(weekly: DataFrame, weekly_dir: str, rebalance: bool = True) -> None:
    """Replace the stored weeks that occur in `weekly` (which has a `week_name`)."""
    _replace_folders(weekly, weekly_dir, "week_name", rebalance)


def register_week(spark: SparkSession, weekly_dir: str, week: str, table: str) -> None:
    """Make a stored week a catalog table, in place of an earlier one. Moves no data.

    A table that is there already with this folder and these columns stays, so that its
    readers always find it; only another folder or other columns replace it.
    """
    path = f"{weekly_dir.rstrip('/')}/week_name={week}"
    if spark.catalog.tableExists(table):
        if _lies_in(spark, table, path):
            spark.catalog.refreshTable(table)
            if spark.table(table).dtypes == spark.read.parquet(path).dtypes:
                return
        spark.sql(f"DROP TABLE {_quoted(table)}")
    spark.catalog.createTable(table, path=path, source="parquet")


def unregister_week(spark: SparkSession, weekly_dir: str, week: str, table: str) -> None:
    """Drop the catalog table of a stored week. A table with another folder stays."""
    path = f"{weekly_dir.rstrip('/')}/week_name={week}"
    if spark.catalog.tableExists(table) and _lies_in(spark, table, path):
        spark.sql(f"DROP TABLE {_quoted(table)}")


def _quoted(table: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in table.split("."))


def _lies_in(spark: SparkSession, table: str, path: str) -> bool:
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}")
    rows = about.filter("col_name = 'Location'").collect()
    return {_plain_path(r["data_type"]) for r in rows} == {_plain_path(path)}


def _plain_path(path: str) -> str:
    return re.sub("/+", "/", path.removeprefix("file:")).rstrip("/")


def save_week_table(weekly: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a catalog table; `path` makes it an external one."""
    writer = weekly.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def save_week_jdbc(
    weekly: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    mode: str = "overwrite",
    connections: int = 8,
) -> None:
    """Replace a database table in batched inserts over a bounded number of connections."""
    (
        weekly.write.format("jdbc")
        .mode(mode)
        .options(url=url, dbtable=table, batchsize=JDBC_BATCH_ROWS, numPartitions=connections)
        .options(**properties)
        .save()
    )


def _csv_value(name: str, kind: T.DataType) -> Column:
    """Plain decimals for money (large doubles would print as 1.2E7), True/False for flags."""
    if name in _MONEY:
        c = F.col(name)
        return F.coalesce(c.try_cast("decimal(28,2)").cast("string"), c.cast("string")).alias(name)
    if isinstance(kind, T.BooleanType):
        return F.initcap(F.col(name).cast("string")).alias(name)
    return F.col(name)


def _as_csv(metric: DataFrame) -> DataFrame:
    return metric.select(*[_csv_value(f.name, f.dataType) for f in metric.schema.fields])


def save_metric(metric: DataFrame, output_dir: str, week: str, slug: str) -> str:
    """Write one metric of one week to `<output>/<week>/<prefix>_<slug>.csv`.

    The five metric tables have at most days x types x 24 rows a week; they become one
    file, sorted in the task that writes it. Nothing bounds other metrics, so they keep
    their partitions.
    """
    path = f"{output_dir.rstrip('/')}/{week}/{metric_file_name(slug, week)}"
    rows = metric
    if slug in METRIC_SCHEMAS:
        keys = [c for c in METRIC_KEYS if c in metric.columns]
        rows = metric.repartition(1).sortWithinPartitions(*keys)
    _as_csv(rows).write.mode("overwrite").option("header", True).csv(path)
    return path


def save_metric_all_weeks(metric: DataFrame, output_dir: str, slug: str) -> str:
    """Write one metric of all weeks to `<output>/<slug>`, with a `week_name` per date.

    A column and not a folder per week: years of weeks would be thousands of tiny files.
    """
    path = f"{output_dir.rstrip('/')}/{slug}"
    rows = _as_csv(in_order(metric))
    if "date" in metric.columns:
        rows = rows.withColumn("week_name", week_name(F.col("date").cast("date")))
    rows.write.mode("overwrite").option("header", True).csv(path)
    return path
