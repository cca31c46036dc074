"""Reading metric CSVs back for the report."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.contracts import (
    AVG_REVENUE_ALIAS,
    DATE_ALIAS,
    METRIC_SCHEMAS,
    REPORT_COLUMNS,
    REVENUE_ALIAS,
    TRIPS_ALIAS,
    DataValidationError,
    require_columns,
)
from tripweave.functions.weeks import date_text, metric_file_name

_TYPES = {c: kind for columns in METRIC_SCHEMAS.values() for c, kind in columns.items()}
_TYPES["total_revenue"] = _TYPES["total_revenue_per_day"]


def current_names(df: DataFrame) -> DataFrame:
    """Old header names to current ones, unless the current one is there already."""
    present = set(df.columns)
    taken = {
        DATE_ALIAS: {"date"},
        TRIPS_ALIAS: {"total_trips"},
        REVENUE_ALIAS: {"total_revenue", "total_revenue_per_day"},
        AVG_REVENUE_ALIAS: {"avg_revenue_per_trip"},
    }
    renames = {
        old: new for (old, new), names in taken.items() if old in present and not names & present
    }
    return df.withColumnsRenamed(renames)


def standard_dates(df: DataFrame) -> DataFrame:
    """`date` as ISO text; if any value is not a date the whole column stays as it is.

    Metric files hold one row per day and type (or hour), so the look-ahead is cheap.
    """
    if "date" not in df.columns:
        return df
    parsed = F.col("date").try_cast("date")
    strange = df.filter(F.col("date").isNotNull() & parsed.isNull())
    return df.withColumn("date", date_text(parsed)) if strange.isEmpty() else df


def read_metric_csv(spark: SparkSession, path: str, required: Iterable[str]) -> DataFrame:
    """A metric CSV, given as a file or as a folder of part files.

    The header decides the columns; known ones get their contract type. All part files
    of a folder are read, and one with other columns or another order is an error. A whole
    number may be written as 12.0; text that does not fit its type is an error, an empty
    field is NULL.
    """
    try:
        text = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    named = current_names(text)
    require_columns(named, required, path)
    typed = {c: _typed(c) for c in named.columns if c in _TYPES}
    _require_fit(named, typed, path)
    return standard_dates(named.withColumns(typed))


def _typed(name: str) -> Column:
    kind, text = _TYPES[name], F.col(name)
    if kind not in ("int", "bigint"):
        return text.try_cast(kind)
    number = text.try_cast("decimal(38,9)")
    return F.when(number == F.floor(number), number.try_cast(kind))


def _require_fit(named: DataFrame, typed: dict[str, Column], path: str) -> None:
    """Raise if a value would be lost; one pass over a small file."""
    if not typed:
        return
    misfits = [F.count_if(F.col(c).isNotNull() & t.isNull()).alias(c) for c, t in typed.items()]
    try:
        counts = named.agg(*misfits).first().asDict()
    except (PySparkException, Py4JJavaError) as error:
        if "header does not conform" not in str(error):
            raise
        raise DataValidationError(f"{path}: part files differ in their columns") from error
    for name, n in counts.items():
        if n:
            raise DataValidationError(f"{path}: {n} values of {name} are no {_TYPES[name]}")


def read_week_metric(spark: SparkSession, output_dir: str, week: str, slug: str) -> DataFrame:
    """One metric of one week as written by `operators.sinks.save_metric`."""
    path = f"{output_dir.rstrip('/')}/{week}/{metric_file_name(slug, week)}"
    return read_metric_csv(spark, path, REPORT_COLUMNS[slug])


def read_all_weeks_metric(spark: SparkSession, output_dir: str, slug: str) -> DataFrame:
    """One metric of all weeks as written by `operators.sinks.save_metric_all_weeks`."""
    return read_metric_csv(spark, f"{output_dir.rstrip('/')}/{slug}", REPORT_COLUMNS[slug])
