"""Listing and removing folders through the file system that Spark uses for a path."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def _children(spark: SparkSession, path: str) -> list:
    try:
        files, location = _at(spark, path)
        return list(files.listStatus(location)) if files.exists(location) else []
    except (Py4JJavaError, PySparkException) as error:
        if "FileNotFoundException" in str(error):  # went away in between
            return []
        raise


def key_folders(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the ``key=value`` folders below a path, in order; none if it is absent."""
    names = (s.getPath().getName() for s in _children(spark, path) if s.isDirectory())
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{key}="))


def data_files(
    spark: SparkSession, path: str, hidden: str | tuple[str, ...] = ("_", ".")
) -> frozenset[str]:
    """Names of the data files directly in a folder."""
    names = (s.getPath().getName() for s in _children(spark, path) if s.isFile())
    return frozenset(n for n in names if not n.startswith(hidden))


def remove(spark: SparkSession, path: str) -> None:
    files, location = _at(spark, path)
    files.delete(location, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    files, location = _at(spark, path)
    stream = files.create(location, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None where there is none."""
    files, location = _at(spark, path)
    if not files.exists(location):
        return None
    stream = files.open(location)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
