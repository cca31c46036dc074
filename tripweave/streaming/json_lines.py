"""Events that arrive as lines of JSON, with the broken ones set apart and counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What is wrong with a line; the landed table has a folder for each.
SOUND, BROKEN, INCOMPLETE = "none", "broken", "incomplete"
TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}
_CORRUPT = "_corrupt_line"


def stream_lines(
    spark: SparkSession, folder: str, file_glob: str = "*", files_per_batch: int | None = None
) -> DataFrame:
    """A stream of the lines (``value``) of the text files that appear in a folder."""
    reader = spark.readStream.option("pathGlobFilter", file_glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def _more_than_one(line: Column) -> Column:
    """Whether something follows the first value of a line, or a name comes twice in it."""
    all_of_it = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    return F.coalesce(F.size(all_of_it.cast("array<variant>")) != 1, F.lit(True))


def parse_lines(lines: DataFrame, schema: T.StructType, needed: Sequence[str] = ()) -> DataFrame:
    """The columns of ``schema`` with ``line`` and ``problem``. Works on a stream as well.

    A line is 'broken' if it is no single JSON object, names a column twice or holds a value
    that does not fit its column's type; 'incomplete' if a ``needed`` column is absent or
    null. Such a line is kept whole in ``line`` (null for the others) and its columns are
    null. Columns that the schema lacks are ignored, absent ones are null, and lines without
    anything but white space are no records.
    """
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {**TIMES, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    line = F.col("value")
    parsed = lines.filter(F.length(F.regexp_replace(line, r"\s+", "")) > 0).select(
        line, F.from_json(line, wide, options).alias("r")
    )
    record = F.col("r")
    broken = record.isNull() | record[_CORRUPT].isNotNull() | _more_than_one(line)
    gaps = F.lit(False)
    for name in needed:
        gaps = gaps | record[name].isNull()
    judged = parsed.withColumn(
        "problem",
        F.when(broken, F.lit(BROKEN)).when(gaps, F.lit(INCOMPLETE)).otherwise(F.lit(SOUND)),
    )
    sound = F.col("problem") == SOUND
    return judged.select(
        *[F.when(sound, record[f.name]).alias(f.name) for f in schema],
        F.when(~sound, line).alias("line"),
        "problem",
    )


def land_lines(parsed: DataFrame, folder: str, checkpoint_dir: str) -> None:
    """Write a stream of parsed lines, each once, until the input is used up.

    One query and one scan feed both branches: sound records and the lines set apart are
    folders of one table, committed together batch by batch, so a restart loses no line
    and doubles none.
    """
    query = (
        parsed.writeStream.format("parquet")
        .partitionBy("problem")
        .option("path", folder)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _landed_schema(schema: T.StructType) -> T.StructType:
    text = T.StringType()
    return T.StructType(
        [*schema.fields, T.StructField("line", text), T.StructField("problem", text)]
    )


def stream_sound(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A stream of the sound records that `land_lines` has written and goes on writing."""
    landed = spark.readStream.schema(_landed_schema(schema)).parquet(folder)
    return landed.filter(F.col("problem") == SOUND).drop("line", "problem")


def set_apart(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """(problem, line) of every line that is no sound record. Reads their folders only."""
    landed = spark.read.schema(_landed_schema(schema)).parquet(folder)
    return landed.filter(F.col("problem") != SOUND).select("problem", "line")
