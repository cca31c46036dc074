"""The columns of a store, noted when it is written, so that no read opens a footer."""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tripweave.sources.folders import data_files, key_folders, read_text, write_text
from tripweave.sources.footers import merged_schema, same_columns

#: Beside the folders of a store; Spark's readers skip it.
NOTES = "_schemas"


def note_schema(spark: SparkSession, path: str, key: str, schema: T.StructType) -> None:
    """Note that files of this schema are about to be written below a store's ``key`` folders.

    Each distinct schema is a file of its own, named by its content: writers at the same
    time do not disturb one another, and a write with known columns notes nothing new. A
    store from before has the columns of its footers noted first, in one job.
    """
    root = path.rstrip("/")
    noted = data_files(spark, _notes(root), hidden=".")
    schemas = [T.StructType([f for f in schema if f.name != key])]
    if not noted and key_folders(spark, root, key):
        before = merged_schema(spark, [root])
        if before is not None:
            schemas.append(T.StructType([f for f in before if f.name != key]))
    for one in schemas:
        text = json.dumps(_nullable(one).jsonValue(), sort_keys=True)
        name = f"{len(one.fields):05d}-{hashlib.sha256(text.encode()).hexdigest()}.json"
        if name not in noted:
            write_text(spark, f"{_notes(root)}/{name}", text)


def noted_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of all noted schemas, those with fewest columns first.

    None where nothing is noted, or where two of them disagree on a type: the footers then
    tell what the files that are still there have. Columns whose days were all replaced since
    stay, as NULL.
    """
    root = path.rstrip("/")
    names = sorted(data_files(spark, _notes(root), hidden="."))
    texts = [read_text(spark, f"{_notes(root)}/{name}") for name in names]
    schemas = [T.StructType.fromJson(json.loads(text)) for text in texts if text]
    if not schemas:
        return None
    return reduce(lambda a, b: a if a is None else same_columns(spark, a, b), schemas)


def _notes(root: str) -> str:
    return f"{root}/{NOTES}"


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])
