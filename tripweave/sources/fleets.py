"""Raw fleet files and their normalization to one trip schema."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.contracts import (
    GREEN_RENAMES,
    GREEN_TAG,
    TRIP_TYPES,
    YELLOW_RENAMES,
    YELLOW_TAG,
    DataValidationError,
)
from tripweave.functions.numbers import exact
from tripweave.functions.weeks import parse_day
from tripweave.functions.zones import clock_kind, first_reading, last_reading, reading_after
from tripweave.sources.footers import group_files, merged_schema, read_groups

TRIP_TIMES = ("pickup_datetime", "dropoff_datetime")
CLOCK_MARKS = {"pickup_datetime": "pickup_clock", "dropoff_datetime": "dropoff_clock"}


def _widened(found: T.StructField) -> Column:
    wanted = TRIP_TYPES.get(found.name)
    same = wanted in (None, found.dataType.simpleString())
    if same or not isinstance(found.dataType, T.NumericType):
        return exact(found.name)
    return exact(found.name).cast(wanted)


@dataclass(frozen=True)
class SourceSpec:
    """How one source becomes trips: which columns to rename, which tag to add.

    ``paths`` may hold files, folders or globs. A source with ``time_zone`` has its
    local times moved to ``target_zone``. Files whose types changed over time are widened
    from their footers with ``widen``, or read by ``versions`` and a ``file_day`` pattern
    whose first group is the date (or the month) in a file's path.

    A local time that the clocks show twice is its first occurrence, but a dropoff that would
    then lie before its pickup is the second one; with ``second_of_repeated`` all are. A
    time that the clocks skip moves on by the gap. ``mark_clock`` adds what each time is
    (see `clock_kind`), for `count_clock_marks`.
    """

    tag: str
    renames: Mapping[str, str] = field(default_factory=dict)
    paths: tuple[str, ...] = ()
    time_zone: str | None = None
    target_zone: str = "UTC"
    versions: tuple[SchemaVersion, ...] = ()
    file_day: str = r"(\d{4}-\d{2}(?:-\d{2})?)"
    widen: bool = False
    second_of_repeated: bool = False
    mark_clock: bool = False

    def read(self, spark: SparkSession) -> DataFrame:
        """All files, each column of any of them included.

        With versions there is one scan per version. Without, the columns of all footers are
        merged. Files that disagree on a type are an error then, or with ``widen`` one scan
        per type, brought to the type that holds both.
        """
        if self.versions:
            files = {p: _day_of(p, self.file_day) for p in self._files(spark)}
            return read_versions(spark, files, self.versions)
        schema = merged_schema(spark, self.paths)
        if schema is not None:
            return spark.read.schema(schema).parquet(*self.paths)
        if not self.widen:
            raise DataValidationError(
                f"files of {self.tag} disagree on a type; set widen=True or give their versions"
            )
        return read_groups(spark, group_files(spark, self._files(spark)))

    def _files(self, spark: SparkSession) -> list[str]:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        paths = listed.load(list(self.paths)).select("path").collect()
        return [r["path"] for r in paths if r["path"].endswith(".parquet")]

    def normalize(self, raw: DataFrame) -> DataFrame:
        """Rename, widen, tag and shift.

        Names match case-sensitively, absent ones are ignored. Numbers get their contract
        type, so that days stored from files of different types still fit together.
        """
        columns = [_widened(f).alias(self.renames.get(f.name, f.name)) for f in raw.schema.fields]
        trips = raw.select(*columns).withColumn("taxi_type", F.lit(self.tag))
        return trips if self.time_zone is None else self._shifted(trips, self.time_zone)

    def _shifted(self, trips: DataFrame, zone: str) -> DataFrame:
        local = {c: F.col(c).cast("timestamp_ntz") for c in TRIP_TIMES if c in trips.columns}
        read = last_reading if self.second_of_repeated else first_reading
        moved = {c: read(at, zone, self.target_zone) for c, at in local.items()}
        if len(moved) == len(TRIP_TIMES) and not self.second_of_repeated:
            pickup, dropoff = TRIP_TIMES
            moved[dropoff] = reading_after(
                moved[pickup], local[dropoff], zone, self.target_zone
            )
        marks = {}
        if self.mark_clock:
            marks = {CLOCK_MARKS[c]: clock_kind(at, zone) for c, at in local.items()}
        return trips.withColumns(moved | marks)


GREEN = SourceSpec(GREEN_TAG, GREEN_RENAMES)
YELLOW = SourceSpec(YELLOW_TAG, YELLOW_RENAMES)


def pickup_only(spec: SourceSpec) -> SourceSpec:
    """The variant that renames the pickup time only and tags in lower case."""
    renames = {old: new for old, new in spec.renames.items() if new == "pickup_datetime"}
    return SourceSpec(spec.tag.lower(), renames, spec.paths, spec.time_zone, spec.target_zone)


def common_columns(frames: Sequence[DataFrame]) -> list[str]:
    """Columns that every frame has, compared case-sensitively, in ascending order."""
    return sorted(set.intersection(*(set(f.columns) for f in frames)))


def combine(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames over their common columns; numbers widen, duplicates stay."""
    names = common_columns(frames)
    picked = [f.select(*[exact(c) for c in names]) for f in frames]
    return reduce(DataFrame.unionByName, picked)


def count_clock_marks(trips: DataFrame) -> DataFrame:
    """(taxi_type, pickup_clock, dropoff_clock, trips) of marked trips, in one row per kind."""
    kinds = [m for m in CLOCK_MARKS.values() if m in trips.columns]
    return trips.groupBy("taxi_type", *kinds).agg(F.count(F.lit(1)).alias("trips"))


def load_trips(spark: SparkSession, specs: Sequence[SourceSpec]) -> DataFrame:
    """Read, normalize and combine the given sources as one lazy plan."""
    return combine([spec.normalize(spec.read(spark)) for spec in specs])


@dataclass(frozen=True)
class SchemaVersion:
    """A schema that holds for the files dated before ``until`` (None: from then on)."""

    schema: T.StructType
    until: str | None = None

    def covers(self, day: date) -> bool:
        return self.until is None or day < parse_day(self.until)


def _day_of(path: str, pattern: str) -> str:
    found = re.search(pattern, path)
    if found is None:
        raise DataValidationError(f"no date in the path {path!r}")
    return found[1] if len(found[1]) > 7 else f"{found[1]}-01"


def schema_for(versions: Sequence[SchemaVersion], day: str) -> T.StructType:
    """The first version that covers a file date."""
    when = parse_day(day)
    return next(v.schema for v in versions if v.covers(when))


def read_versions(
    spark: SparkSession, files: Mapping[str, str], versions: Sequence[SchemaVersion]
) -> DataFrame:
    """Read dated files, each under its version's schema; absent columns become NULL.

    ``files`` maps a path to its file date. Files of one version share one scan.
    """
    by_version: dict[int, list[str]] = {}
    for path, day in sorted(files.items()):
        schema = schema_for(versions, day)
        index = next(i for i, v in enumerate(versions) if v.schema is schema)
        by_version.setdefault(index, []).append(path)
    frames = [
        spark.read.schema(versions[i].schema).parquet(*paths) for i, paths in by_version.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
