"""The registered queries of the operators, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import (
    bpe,
    chat_format,
    decontaminate,
    html_text,
    line_dedup,
    periodic_runs,
    quality_rules,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    suffix_array,
    warc,
)
from tripweave.llm.frames import WORD_GAP, saved, table
from tripweave.session import shared_dir

WORD_BPE = "word_bpe_49k.json"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select(
        "page_id",
        "url",
        F.col("main_text").alias("text"),
        F.length("main_text").cast("long").alias("n_chars"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that its source repeats on too many documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, dropped="n_dropped").select(
        "doc_id", "source", "n_dropped", "text"
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text, encoded and decoded again."""
    path = public_tokenizers.path(WORD_BPE)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, path).select(
        "doc_id",
        F.floor(F.octet_length("tokens") / 4).alias("n_tokens"),
        F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of turns and trained text, read back from the formatted conversations."""
    hard = "\\\\### Assistant: </turn> ok"
    more = spark.sql(
        f"SELECT * FROM VALUES (-7L, 0L, 'user', '{hard}'), (-7L, 1L, 'assistant', '{hard}') "
        "AS t(conv_id, turn, role, text)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = chat_format.format_chats(rows.unionByName(more))
    turns = chat_format.parse(F.col("formatted"))
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
        "",
    )
    return (
        chats.withColumn("turns", turns)
        .withColumn("loss", chat_format.trained_text(F.col("runs")))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(said, 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the word windows that start earlier in the corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id",
        "deduped.n_words",
        "deduped.n_removed",
        F.sha2("deduped.text", 256).alias("kept_sha256"),
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the place and the number of edits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the byte strings that start in a smaller document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_array.remove_shared(docs).select(
        "doc_id",
        "deduped.n_bytes",
        "deduped.n_removed",
        "deduped.n_spans",
        F.sha2("deduped.kept", 256).alias("kept_sha256"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document, and the verdict of the current policy."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.ledger(docs)
    failed = F.col("ledger.failed")
    base = ~quality_rules.passes(failed, "base")
    return judged.select(
        "doc_id",
        *[f"ledger.{c}" for c in quality_rules.MEASURES if c != "n_lines"],
        base.alias("base_failed"),
        (~base & quality_rules.passes(failed)).alias("kept"),
        failed.alias("failed_bits"),
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_groups(docs, width=4, distance=4)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages say when they are read back."""
    path = shared_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    found = warc.records(warc.read_archives(spark, path))
    return found.select(
        warc.id_of(F.col("record_id")).alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), "payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        warc.id_of(F.col("refers_to")).alias("refers_to"),
    )


def _periodic_tail(words: Column, g: Column) -> Column:
    """Words joined by one space, from place g % n on replaced by a repeated stretch of them."""
    n = F.size(words)
    first = F.pmod(g, n).cast("int")
    period = (1 + F.floor((n - first) / (3 + g % 8))).cast("int")
    repeated = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get(words, F.when(i < first, i).otherwise(first + (i - first) % period)),
    )
    return F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.lit(""))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document; a tenth of the documents get a periodic tail first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", WORD_GAP), lambda w: w != "")
    # bound by a lambda, so that the text is not split again for each of its words
    tail = F.transform(F.array(words), lambda ws: _periodic_tail(ws, F.floor(h / 10)))[0]
    text = F.when(h % 10 == 0, tail).otherwise(F.col("text"))
    # a generator keeps the lambdas out of the operator's argument, where Spark loses track of them
    planted = docs.select("doc_id", F.explode(F.array(text)).alias("text"))
    found = periodic_runs.with_runs(planted)
    runs = F.col("periodic.runs")
    # quotients of lengths and periods below 2^27 are told apart, and equal ones are equal
    ranked = F.transform(
        runs, lambda r: F.struct((-(r["length"] / r["period"])).alias("e"), r.alias("run"))
    )
    best = F.array_min(ranked)["run"]
    lines = F.transform(
        runs,
        lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")),
    )
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words with their near words, forms and roots; of some runs a letter is missing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    runs = docs.select("doc_id", F.explode(spelling.words_of(F.col("text"), 6)).alias("w"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("w")).cast("binary"))
    size = F.char_length("w")
    gone = (h % size).cast("int")
    shorter = F.concat(F.col("w").substr(F.lit(1), gone), F.col("w").substr(gone + 2, size))
    words = runs.select(F.when(h % 199 == 0, shorter).otherwise(F.col("w")).alias("word"))
    return spelling.group_variants(spelling.count_words(words)).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document, from eight shards that were written and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    docs = docs.withColumn("size", size)
    keys, path = ("doc_id", "text"), shared_dir(spark, "shards")
    loads = saved(sharding.slot_loads(docs, keys, "size"), "slot-loads")
    dealt = sharding.save_map(sharding.first_map(spark, 8), f"{path}/map", 1)
    balanced = sharding.save_map(sharding.rebalanced(dealt, loads, 8), f"{path}/map", 2)
    sharding.write_shards(docs, balanced, keys, f"{path}/rows")
    return sharding.read_shards(docs, f"{path}/rows").select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_line_dedup": op2_line_dedup,
    "op3_bpe": op3_bpe,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_warc": op10_warc,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_sharding": op13_sharding,
}
