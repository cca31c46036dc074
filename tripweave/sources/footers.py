"""Reading files whose schemas nobody wrote down: grouped by what their footers say."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripweave.contracts import DataValidationError
from tripweave.functions.numbers import exact
from tripweave.session import at_once

#: Footer jobs that run side by side.
AT_ONCE = 16
_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}  # type -> digits
_REAL = ("float", "double")
_MOST_DIGITS = 38


@dataclass(frozen=True)
class FileGroup:
    """Files that agree on the type of every column; ``schema`` has the columns of all."""

    schema: T.StructType
    paths: tuple[str, ...]


def merged_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """The columns of all files, from their footers in one Spark job; None if types clash."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" in str(error):
            return None
        raise


def _halves(paths: Sequence[str]) -> list[Sequence[str]]:
    middle = len(paths) // 2
    return [paths[:middle], paths[middle:]]


def _same_case(spark: SparkSession):
    return str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower


def same_columns(spark: SparkSession, a: T.StructType, b: T.StructType) -> T.StructType | None:
    """The columns of both, or None where one column has two types."""
    key = _same_case(spark)
    known = {key(f.name): f.dataType for f in a}
    if any(known.get(key(f.name), f.dataType) != f.dataType for f in b):
        return None
    return T.StructType(list(a) + [f for f in b if key(f.name) not in known])


def group_files(spark: SparkSession, paths: Sequence[str]) -> list[FileGroup]:
    """The files, grouped so that no group disagrees on a type.

    Footers are read by Spark jobs over many files at once, through whatever file system Spark
    has. Files that clash are halved in the order of their names, and the halves of a round go
    side by side: types that change k times over n dated files cost about k log n jobs, files
    in any order at most 2 n. Runs of files that fit together then share a group again, so
    there are as many groups as there are clashing schemas.
    """
    found: dict[str, FileGroup] = {}
    waiting: list[Sequence[str]] = [sorted(paths)] if paths else []
    while waiting:
        now, waiting = waiting[:AT_ONCE], waiting[AT_ONCE:]
        schemas = at_once(spark, [partial(merged_schema, spark, p) for p in now])
        for part, schema in zip(now, schemas, strict=True):
            if schema is not None:
                found[part[0]] = FileGroup(schema, tuple(part))
            elif len(part) == 1:
                raise DataValidationError(f"the footer of {part[0]!r} contradicts itself")
            else:
                waiting += _halves(part)
    groups: list[FileGroup] = []
    for _, new in sorted(found.items()):
        for i, old in enumerate(groups):
            schema = same_columns(spark, old.schema, new.schema)
            if schema is not None:
                groups[i] = FileGroup(schema, old.paths + new.paths)
                break
        else:
            groups.append(new)
    return groups


def _as_decimal(kind: T.DataType) -> tuple[int, int] | None:
    """(digits before the point, digits after it) of a whole or decimal type."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    digits = _WHOLE.get(kind.simpleString())
    return None if digits is None else (digits, 0)


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds values of both, or None where that would be a guess.

    Whole numbers take the longer type, whole or decimal with floating numbers is double,
    decimals take as many digits as both need on either side of the point (double beyond 38),
    a day with a zone-less time is a time at midnight, and an untyped column takes any type.
    Text with numbers, zoned with zone-less times and nested columns that differ have none.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    names = {a.simpleString(), b.simpleString()}
    if names <= set(_WHOLE):
        return max(a, b, key=lambda kind: _WHOLE[kind.simpleString()])
    if names == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    if not all(isinstance(kind, T.NumericType) for kind in (a, b)):
        return None
    if names & set(_REAL):
        return T.DoubleType()
    (whole_a, scale_a), (whole_b, scale_b) = _as_decimal(a), _as_decimal(b)
    whole, scale = max(whole_a, whole_b), max(scale_a, scale_b)
    return T.DecimalType(whole + scale, scale) if whole + scale <= _MOST_DIGITS else T.DoubleType()


def widest(spark: SparkSession, groups: Sequence[FileGroup]) -> Mapping[str, T.StructField]:
    """Each column of any group with the type that holds all of its values."""
    key, columns = _same_case(spark), {}
    for group in groups:
        for field in group.schema:
            old = columns.setdefault(key(field.name), field)
            kind = wider(old.dataType, field.dataType)
            if kind is None:
                raise DataValidationError(
                    f"files disagree on a type that cannot be widened: {field.name} is "
                    f"{old.dataType.simpleString()} and {field.dataType.simpleString()} "
                    f"(in {group.paths[0]!r})"
                )
            columns[key(field.name)] = T.StructField(old.name, kind)
    return columns


def read_groups(spark: SparkSession, groups: Sequence[FileGroup]) -> DataFrame:
    """All rows of all groups, one scan per group; columns that a group lacks are NULL.

    A column is cast only in the groups whose type is narrower, so filters on the others
    still reach the files.
    """
    key, columns = _same_case(spark), widest(spark, groups)

    def read(group: FileGroup) -> DataFrame:
        rows = spark.read.schema(group.schema).parquet(*group.paths)
        wanted = [(f, columns[key(f.name)]) for f in group.schema]
        return rows.select(
            *[
                (exact(f.name) if f.dataType == w.dataType else exact(f.name).cast(w.dataType))
                .alias(w.name)
                for f, w in wanted
            ]
        )

    union = partial(DataFrame.unionByName, allowMissingColumns=True)
    return reduce(union, [read(g) for g in groups])
