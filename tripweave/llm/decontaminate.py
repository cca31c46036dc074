"""Benchmark items inside documents, up to a share of edits.

By the pigeonhole principle an occurrence with at most ``e`` edits leaves one of ``e + 1``
pieces of the item untouched; and of the pieces taken in groups, one group of ``g`` has at most
``g - 1`` edits. An automaton over all pieces finds them in one pass over the text. Myers'
bit-parallel distance then decides each place that a piece was found at, first for the group
around the piece and then for the whole item.

Documents are neither shuffled nor collected. The items are the query set: they go to the
workers in blocks of bounded size, one pass over the documents per block, so a benchmark of
any size is searched in full.

Defined results: texts and items are compared in lower case with white space runs as one
space; null texts are empty; an item shorter than ``LEAST_CHARS`` after that must stand
exactly and between word borders; items of fewer than ``LEAST_WORDS`` words, null ones among
them, say nothing about their source and are not searched for, ``not_searched`` names them;
an item without an id is searched for like others; of equal items each is reported; an
item is reported once per document, at its best place, the first of equals; repeated document ids give one row with the smallest distance; further columns are ignored
by ``find_leaks`` and kept by ``drop_leaking``; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.frames import free_name, saved

ERROR_RATE = 0.08
LEAST_CHARS = 30
LEAST_WORDS = 3
#: Pieces whose surroundings are checked together before the whole item is.
GROUP = 4
#: Characters of the items that one pass searches for.
BLOCK_CHARS = 4 << 20
LEAK = "array<struct<item:bigint,distance:int,start:int,end:int>>"


def _bordered(text: str, first: int, stop: int) -> bool:
    """Whether no word goes on across either end of ``text[first:stop]``."""
    before = first > 0 and text[first - 1].isalnum() and text[first].isalnum()
    after = stop < len(text) and text[stop].isalnum() and text[stop - 1].isalnum()
    return not before and not after


def plain(text: str) -> str:
    return " ".join(text.lower().split())


class Myers:
    """Bit-parallel edit distance of a pattern to the best substring of a text."""

    def __init__(self, pattern: str):
        self.n = len(pattern)
        self.full = (1 << self.n) - 1
        self.places: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.places[c] = self.places.get(c, 0) | 1 << i

    def best(self, text: str, first: int, last: int, most: int) -> tuple[int, int] | None:
        """(distance, end) of the best match that ends in ``text[first:last]``."""
        places, full, high = self.places, self.full, 1 << (self.n - 1)
        up, down, score, found = full, 0, self.n, None
        for at in range(first, last):
            same = places.get(text[at], 0)
            zero = ((((same & up) + up) ^ up) | same | down) & full
            plus = down | (full ^ (zero | up))
            minus = up & zero
            if plus & high:
                score += 1
            elif minus & high:
                score -= 1
            if score <= most:
                found, most = (score, at + 1), score - 1
                if not score:
                    break
            plus = plus << 1 & full
            minus = minus << 1 & full
            up = minus | (full ^ (zero | plus))
            down = plus & zero
        return found


class Pieces:
    """The pieces of a block of items, in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = items
        self.short = [len(text) < LEAST_CHARS for _, text in items]
        self.budget = [int(len(t) * rate) * (len(t) >= LEAST_CHARS) for _, t in items]
        self.myers: dict[int, tuple[Myers, Myers]] = {}
        self.groups: list[tuple[int, int, int, int, Myers]] = []  # item, from, to, edits
        owners: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(items):
            n = self.budget[k] + 1
            cuts = [len(text) * j // n for j in range(n + 1)]
            edges = [*range(0, max(n - GROUP, 0) + 1, GROUP), n]
            for i, j in zip(edges, edges[1:], strict=False):
                a, b = cuts[i], cuts[j]
                self.groups.append((k, a, b, j - i - 1, Myers(text[a:b])))
                for x, y in zip(cuts[i:j], cuts[i + 1 : j + 1], strict=True):
                    owners.setdefault(text[x:y], []).append((len(self.groups) - 1, y))
        self.automaton = ahocorasick.Automaton()
        for piece, places in owners.items():
            self.automaton.add_word(piece, places)
        if owners:
            self.automaton.make_automaton()

    def _windows(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Where each item may stand, as separate ranges of the text."""
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, places in self.automaton.iter(text):
            for group, end in places:
                k, a, b, edits, myers = self.groups[group]
                if self.short[k] and not _bordered(text, last + 1 - end, last + 1):
                    continue
                first = last + 1 - (end - a) - edits
                stop = min(first + b - a + 2 * edits, len(text))
                if edits and not myers.best(text, max(first, 0), stop, edits):
                    continue
                e = self.budget[k]
                first = last + 1 - end - e
                stop = first + len(self.items[k][1]) + 2 * e
                spans = windows.setdefault(k, [])
                if self.short[k]:  # the place itself, of which the first is best
                    spans.append((first, stop))
                elif spans and first <= spans[-1][1] and spans[-1][0] <= stop:
                    spans[-1] = (min(first, spans[-1][0]), max(stop, spans[-1][1]))
                else:
                    spans.append((first, stop))
        return windows

    def leaks(self, text: str) -> list[tuple[int, int, int, int]]:
        if not len(self.automaton) or not text:
            return []
        text, found = plain(text), []
        for k, spans in self._windows(text).items():
            item, pattern = self.items[k]
            if k not in self.myers:
                self.myers[k] = Myers(pattern), Myers(pattern[::-1])
            ahead, back = self.myers[k]
            most, best = self.budget[k], None
            for first, stop in spans:
                hit = ahead.best(text, max(first, 0), min(stop, len(text)), most)
                if hit:
                    best, most = hit, hit[0] - 1
                if most < 0:
                    break
            if best:
                distance, end = best
                reach = text[max(0, end - len(pattern) - distance) : end][::-1]
                n = back.best(reach, 0, len(reach), distance)[1]
                found.append((item, distance, end - n, end))
        return found


def _searcher(docs: DataFrame, items: list[tuple[int, str]], rate: float):
    shared = docs.sparkSession.sparkContext.broadcast(items)

    @F.pandas_udf(LEAK)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = Pieces(shared.value, rate)
        for texts in batches:
            yield pd.Series(
                [
                    [dict(zip(("item", "distance", "start", "end"), x, strict=True)) for x in found]
                    for found in map(pieces.leaks, texts)
                ],
                dtype=object,
            )

    return search.asNondeterministic()  # else a filter on its result runs it once more


def _text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def not_searched(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of ``items`` that have too few words to be searched for."""
    words = F.split(_text(F.col(f"`{text}`")), r"(?U)\s+")
    return items.filter(F.size(F.filter(words, lambda w: w != "")) < LEAST_WORDS)


def blocks(items: DataFrame, item: str, text: str) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about ``BLOCK_CHARS`` characters, one at a time."""
    all_items = items.select(
        F.col(f"`{item}`").cast("bigint").alias("item"), _text(F.col(f"`{text}`")).alias("t")
    ).filter(F.length("t") > 0)
    chars = all_items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    n_blocks = -(-chars // BLOCK_CHARS)
    at = F.pmod(F.xxhash64("item", "t"), F.lit(max(n_blocks, 1)))
    for k in range(n_blocks):
        rows = all_items.filter(at == k).collect()
        ready = {(r["item"], plain(r["t"])) for r in rows}
        ready = sorted(ready, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        yield [(i, t) for i, t in ready if t.count(" ") >= LEAST_WORDS - 1]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    rate: float = ERROR_RATE,
) -> DataFrame:
    """(doc, item, distance, start, end) of every item within a document.

    An item of n characters may differ by ``int(n * rate)`` edits. ``start`` and ``end`` count
    characters of the compared form of the text.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    keyed = docs.select(F.col(f"`{doc}`").alias("doc"), body.alias("text"))
    found = keyed.select("doc", F.inline(F.array().cast(LEAK))).limit(0)
    passes = [
        keyed.select("doc", _searcher(docs, block, rate)(F.col("text")).alias("leaks")).select(
            "doc", F.inline("leaks")
        )
        for block in blocks(items, item, item_text)
    ]
    for each in passes if len(passes) < 2 else (saved(p, "leaks") for p in passes):
        found = found.unionByName(each)
    best = F.min(F.struct("distance", "start", "end")).alias("best")
    return (
        found.groupBy("doc", "item")
        .agg(best)
        .select(F.col("doc").alias(doc), F.col("item").alias(item), "best.*")
    )


def drop_leaking(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    rate: float = ERROR_RATE,
) -> DataFrame:
    """``docs`` without the documents that hold an item; one pass per block of items."""
    body: Column = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    mark = free_name(docs, "_leaks")
    for k, block in enumerate(blocks(items, item, item_text)):
        if k:  # a pass of its own, so that one block is in memory at a time
            docs = saved(docs, "not-leaking")
        leaks = _searcher(docs, block, rate)(body)
        docs = docs.withColumn(mark, leaks).filter(F.size(mark) == 0).select(*columns)
    return docs
