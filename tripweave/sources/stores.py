"""Reading the daily store, the weekly store and week tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tripweave.contracts import UNKNOWN_WEEK, DataValidationError
from tripweave.functions.weeks import week_name, week_range
from tripweave.sources.folders import key_folders
from tripweave.sources.schemas import noted_schema


def load_days(
    spark: SparkSession, daily_dir: str, days: Sequence[str] | None = None
) -> DataFrame | None:
    """Every stored day, or those in ``days``; None when nothing has been stored yet.

    Columns that only some days have are NULL on the others. They are noted with the store,
    and no footer is opened; for a store without notes, or whose days differ in a type, the
    footers of the days that are read are looked at in a distributed job.
    """
    root = daily_dir.rstrip("/")
    stored = set(key_folders(spark, root, "pickup_date"))
    if not stored or not stored.issuperset(days or ()):
        return None
    reader = _reader(spark, root)
    try:
        if days is None:
            return reader.parquet(root)
        if not days:
            return None
        return reader.option("basePath", root).parquet(*[f"{root}/pickup_date={d}" for d in days])
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _reader(spark: SparkSession, root: str) -> DataFrameReader:
    schema = noted_schema(spark, root)
    if schema is None:
        return spark.read.option("mergeSchema", True)
    return spark.read.schema(schema)


def stored_days(spark: SparkSession, daily_dir: str) -> DataFrame:
    """One row per stored day, with its `week_name`, from the names of the day folders."""
    rows = [(d,) for d in key_folders(spark, daily_dir, "pickup_date")]
    days = spark.createDataFrame(rows, "day string").select(
        F.col("day").cast("date").alias("pickup_date")
    )
    return days.withColumn("week_name", week_name(F.col("pickup_date")))


def days_of_week(days: DataFrame, week: str) -> DataFrame:
    """The stored days of one week name; prunes to at most seven date folders."""
    start, end = week_range(week)
    day = F.col("pickup_date")
    return days.filter((day >= F.lit(start)) & (day < F.lit(end)))


def first_week(stored: DataFrame) -> DataFrame:
    """The week name of the earliest of the stored days, in one row."""
    earliest = F.min_by("week_name", "pickup_date")
    return stored.agg(F.coalesce(earliest, F.lit(UNKNOWN_WEEK)).alias("week_name"))


def load_weeks(spark: SparkSession, weekly_dir: str, weeks: Sequence[str]) -> DataFrame:
    """Several weeks of the weekly store with their `week_name`, in one scan."""
    root = weekly_dir.rstrip("/")
    paths = [f"{root}/week_name={w}" for w in weeks]
    return _reader(spark, root).option("basePath", root).parquet(*paths)


def _checked(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise DataValidationError(f"{what} is empty")
    return df


def load_week_table(spark: SparkSession, table: str) -> DataFrame:
    """A published week table. Missing, unreadable or empty tables are an error."""
    try:
        return _checked(spark.table(table), f"table {table!r}")
    except PySparkException as error:
        raise DataValidationError(f"cannot load table {table!r}: {error}") from error


def load_week(spark: SparkSession, weekly_dir: str, week: str) -> DataFrame:
    """One week of the weekly store, with the same errors. Lists that week's folder only."""
    try:
        rows = spark.read.parquet(f"{weekly_dir.rstrip('/')}/week_name={week}")
        return _checked(rows, f"week {week!r}")
    except PySparkException as error:
        raise DataValidationError(f"cannot load week {week!r}: {error}") from error


def jdbc_options(
    url: str, table: str, days: tuple[str, str] | None = None, connections: int = 8
) -> dict[str, str]:
    """Reader options for a database table of trips.

    ``days`` (first and last pickup day) splits the scan over parallel connections by
    pickup time; rows outside are still read. Without it there is one connection.
    """
    options = {"url": url, "dbtable": table, "preferTimestampNTZ": "true"}
    if days is None:
        return options
    return options | {
        "partitionColumn": "pickup_datetime",
        "lowerBound": f"{days[0]} 00:00:00",
        "upperBound": f"{days[1]} 23:59:59",
        "numPartitions": str(connections),
    }


def load_week_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    days: tuple[str, str] | None = None,
    connections: int = 8,
) -> DataFrame:
    """A week table of a database; see `jdbc_options`."""
    options = jdbc_options(url, table, days, connections) | dict(properties)
    try:
        return _checked(spark.read.format("jdbc").options(**options).load(), f"table {table!r}")
    except PySparkException as error:
        raise DataValidationError(f"cannot load table {table!r}: {error}") from error


def list_week_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names of the published week tables."""
    where = f" IN {database}" if database else ""
    tables = spark.sql(f"SHOW TABLES{where} LIKE 'week_*'")
    return tables.select(F.col("tableName").alias("week_name")).orderBy("week_name")


def list_weeks(trips: DataFrame) -> DataFrame:
    """Distinct week names found in trips."""
    day = F.to_date("pickup_datetime")
    return (
        trips.filter(F.col("pickup_datetime").isNotNull())
        .select(day.alias("d"))
        .distinct()
        .select(week_name(F.col("d")).alias("week_name"))
        .distinct()
        .orderBy("week_name")
    )
