"""Quality rules as a ledger of bits: every rule once per document, policies afterwards.

``ledger`` adds one struct column with the measurements and ``failed``, a bit set of the
rules that the document breaks. A policy is a mask over these bits, so changing a policy or
asking what a rule costs (``ablation``) never touches a text again. Built-in functions only;
nothing is shuffled but the bit sets of an ablation.

Defined results: a null text counts as empty (no words, so ``few_words`` fails); rows with
the same id are judged one by one; all input columns are kept, and the ledger column gets
another name if the input has one of that name; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.frames import WORD_GAP, free_name

#: Words of a window whose repetition is measured.
WINDOW = 5
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
)


@dataclass(frozen=True)
class Limits:
    """Bounds of the rules; shares are per cent of the words or lines."""

    least_words: int = 10
    repeat_share: int = 20
    symbol_share: int = 100
    dup_line_share: int = 50
    least_word_chars: int = 2
    most_word_chars: int = 30


#: The rules in the order of their bits. New rules go to the end, so old ledgers stay valid.
RULES = ("few_words", "repeated_windows", "symbols", "duplicate_lines", "short_words", "long_words")
#: Versioned policies: the rules that reject a document.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "2024-1": ("few_words", "repeated_windows", "symbols", "duplicate_lines"),
    "2024-2": RULES,
}
CURRENT = "2024-2"


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(1 << RULES.index(rule) for rule in rules)


def _broken(m: Column, limits: Limits) -> dict[str, Column]:
    words = m["n_words"]
    return {
        "few_words": words < limits.least_words,
        "repeated_windows": m["n_repeat_words"] * 100 > words * limits.repeat_share,
        "symbols": m["n_symbols"] * 100 > words * limits.symbol_share,
        "duplicate_lines": m["n_dup_lines"] * 100 > m["n_lines"] * limits.dup_line_share,
        "short_words": m["word_chars"] < words * limits.least_word_chars,
        "long_words": m["word_chars"] > words * limits.most_word_chars,
    }


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once.

    One expression of linear size: the optimizer may move it into a filter, and what would be
    a chain of projections is not multiplied there.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _windows(hashes: Column) -> Column:
    """Hashes of all windows, from the hashes of the words."""
    starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
    each = F.transform(starts, lambda i: F.xxhash64(*[hashes[i + j] for j in range(WINDOW)]))
    return F.when(F.size(hashes) >= WINDOW, each).otherwise(F.array().cast("array<bigint>"))


def _covered(at: Column) -> Column:
    """Words covered by windows that start at the sorted places ``at``."""
    steps = F.transform(
        F.sequence(F.lit(1), F.size(at) - 1), lambda i: F.least(F.lit(WINDOW), at[i] - at[i - 1])
    )
    inner = F.aggregate(steps, F.lit(0), lambda total, step: total + step)
    return F.when(F.size(at) > 1, inner + WINDOW).otherwise(F.lit(WINDOW))


def _repeated_words(words: Column) -> Column:
    """Words that stand in a window found twice or more."""

    def places(ranked: Column) -> Column:
        def same(x: Column, i: Column) -> Column:
            before = (i > 0) & (F.get(ranked, i - 1)["w"] == x["w"])
            return before | F.coalesce(F.get(ranked, i + 1)["w"] == x["w"], F.lit(False))

        return F.sort_array(F.transform(F.filter(ranked, same), lambda x: x["i"]))

    def found(windows: Column) -> Column:
        pairs = F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        covered = _let(F.sort_array(pairs), lambda ranked: _let(places(ranked), _covered))
        repeats = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(repeats, covered).otherwise(F.lit(0))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _let(hashes, lambda h: _let(_windows(h), found))


def ledger(
    docs: DataFrame, text: str = "text", limits: Limits = Limits(), name: str = "ledger"
) -> DataFrame:
    """``docs`` with a struct column of the ``MEASURES`` and the bits ``failed``.

    Windows are compared by a 64-bit hash within one document. Repeated windows are found by
    sorting (hash, place), and only in documents that have any, so a document of n words
    takes n log n steps.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    words = F.array_remove(F.split(body, WORD_GAP), "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = _let(
        words, lambda w: F.struct(F.size(w).alias("n"), _repeated_words(w).alias("repeated"))
    )
    of_lines = _let(
        lines,
        lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")),
    )
    measured = _let(
        F.struct(of_words.alias("words"), of_lines.alias("lines")),
        lambda m: F.struct(
            m["words"]["n"].cast("long").alias("n_words"),
            F.length(F.regexp_replace(body, WORD_GAP, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            m["lines"]["n"].cast("long").alias("n_lines"),
            (m["lines"]["n"] - m["lines"]["distinct"]).cast("long").alias("n_dup_lines"),
            m["words"]["repeated"].cast("long").alias("n_repeat_words"),
        ),
    )

    def with_bits(m: Column) -> Column:
        bits = F.lit(0).cast("long")
        for rule, broken in _broken(m, limits).items():
            bit = F.when(broken, F.lit(mask_of((rule,)))).otherwise(F.lit(0))
            bits = bits.bitwiseOR(bit.cast("long"))
        return F.struct(*[m[c].alias(c) for c in MEASURES], bits.alias("failed"))

    return docs.withColumn(free_name(docs, name), _let(measured, with_bits))


def passes(failed: Column, policy: str = CURRENT) -> Column:
    """Whether a bit set of broken rules passes a policy."""
    return failed.bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def keep_good(docs: DataFrame, text: str = "text", policy: str = CURRENT) -> DataFrame:
    """The documents that pass ``policy``, with the columns of ``docs``."""
    name = free_name(docs, "ledger")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    judged = ledger(docs, text, name=name)
    return judged.filter(passes(F.col(f"`{name}`")["failed"], policy)).select(*columns)


def ablation(judged: DataFrame, policy: str = CURRENT, name: str = "ledger") -> DataFrame:
    """What each rule of a policy costs, from a ledger: one row per rule.

    ``n_failed`` documents break the rule, ``n_only`` break no other rule of the policy and
    would come back without it. Documents are first counted per bit set, of which there are
    at most two to the power of the rules.
    """
    mask = mask_of(POLICIES[policy])
    sets = judged.groupBy(F.col(name)["failed"].bitwiseAND(F.lit(mask)).alias("bits")).agg(
        F.count("*").alias("n")
    )
    rules = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), F.lit(mask_of((r,))).cast("long").alias("bit"))
            for r in POLICIES[policy]
        ]
    )
    each = sets.select("bits", "n", F.inline(rules))
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias(
            "n_failed"
        ),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
    )
