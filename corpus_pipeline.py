"""From raw documents to tokens: the pipeline of the training-data operators.

Each stage reads the table its predecessor wrote and calls one operator over all of it. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from tripweave.llm.frames import bounded_batches, saved, table
from tripweave.llm.queries import WORD_BPE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Words of a shingle and differing bits by which documents are near copies.
NEAR = (4, 4)


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current quality policy."""
    return quality_rules.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that their source repeats; every document stays.

    Near copies count as one document, or their own lines would go before the next stage
    keeps one of them.
    """
    bounded_batches(spark)
    shorter = line_dedup.drop_boilerplate(docs, copies=NEAR)
    return shorter.withColumn("n_chars", F.length("text").cast("long"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    bounded_batches(spark)
    width, distance = NEAR
    return simhash.keep_one(docs, width=width, distance=distance)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    bounded_batches(spark)
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each text and the text they decode to."""
    bounded_batches(spark)
    path = public_tokenizers.path(WORD_BPE)
    return bpe.round_trip(docs, path)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

#: SQL can express neither the fingerprints nor the exact merges.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
