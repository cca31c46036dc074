"""Runs of windows that share a minimizer, and which of them can repeat.

A window is ``length`` consecutive symbols of a document. Its minimizer is the least hash of
the ``gram``-symbol strings inside it, the first of equals, so equal windows have equal
minimizers at equal places within them. Neighbouring windows mostly share theirs and form a
run; equal windows never stand in one run. So a window whose minimizer occurs in one run only
cannot repeat, and everything that follows looks at the other runs.

The more text, the more short strings occur twice by chance. A wide minimizer is a string of
more than half a window: the least hash of short strings is looked for as above, and the
minimizer begins there, or half a window before if the window would not hold it. It is found
from the window alone, too, and hardly ever repeats unless the text around it does.

All functions take the symbols of many documents one after the other, as numpy arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.frames import saved, saved_at, slices, text_bytes
from tripweave.sources.folders import remove

#: Bytes of text that are turned into arrays at once; the arrays fit into a core's cache.
SLICE = 256 << 10
#: Bits that hold a place within a slice while hashes are compared by the others.
PLACE = np.uint64((1 << 30) - 1)
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


#: Hashes of the strings of so many neighbouring values, at all places or at some.
Grams = Callable[..., np.ndarray]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = (x + np.uint64(MIX[0])) * np.uint64(MIX[1])
    x ^= x >> np.uint64(29)
    x *= np.uint64(MIX[2])
    x ^= x >> np.uint64(32)
    return x


def grams(values: np.ndarray, n: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of all strings of ``n`` neighbouring values, or of those ``at`` some places, by
    doubling."""
    if at is not None:
        return grams(values, n)[at]
    if len(values) < n:
        return values[:0]
    out, have, size = None, mix(values), 1
    covered = 0
    while True:
        if n & size:
            m = len(values) - covered - size + 1
            part = have[covered : covered + m] if out is not None else have
            out = part if out is None else mix(out[:m] * np.uint64(MIX[2]) + part)
            covered += size
            if covered == n:
                return out[: len(values) - n + 1]
        have = mix(have[:-size] * np.uint64(MIX[1]) + have[size:])
        size *= 2


def byte_grams(values: np.ndarray, n: int, at: np.ndarray | None = None) -> np.ndarray:
    """``grams`` of bytes, eight of which are one number."""
    if n < 8 or len(values) < n:
        return grams(values, n, at)
    data = values.astype(np.uint8)
    eights = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))  # one from each byte on
    if at is None:
        eights = eights.astype(np.uint64)
        m = len(eights) - (n - 8)
        parts = [eights[k : k + m] for k in (*range(0, n - 8, 8), n - 8)]
    else:
        parts = [eights[at + k] for k in (*range(0, n - 8, 8), n - 8)]
    out = parts[0]
    for part in parts[1:]:
        out = mix(out * np.uint64(MIX[1]) + part)
    return out if n > 8 else mix(out)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass
class Runs:
    """Runs in order: minimizer, place of the first window, number of windows, document."""

    key: np.ndarray
    start: np.ndarray
    count: np.ndarray
    doc: np.ndarray

    def take(self, chosen: np.ndarray) -> Runs:
        return Runs(self.key[chosen], self.start[chosen], self.count[chosen], self.doc[chosen])


def wide(length: int, gram: int) -> tuple[int, int, int]:
    """Of wide minimizers: the symbols of what is compared, the places at which a minimizer can
    stand in its window, the symbols of a minimizer."""
    anchor = gram // 2 + 1
    places = (length - anchor + 2) // 2
    return anchor, places, length - places + 1


def runs_of(
    values: np.ndarray,
    ends: np.ndarray,
    length: int,
    gram: int,
    hashes_of: Grams = grams,
    widely: bool = False,
) -> Runs:
    """Runs of windows inside documents that end at ``ends``; ``widely``: by wide minimizers."""
    total = len(values) - length + 1
    none = np.zeros(0, np.int64)
    if total <= 0:
        return Runs(none.view(np.uint64), none, none, none)
    anchor, places, size = wide(length, gram) if widely else (gram, length, gram)
    hashes = hashes_of(values, anchor)
    ranked = hashes & ~PLACE | np.arange(len(hashes), dtype=np.uint64)
    place = (least(ranked, length - anchor + 1)[:total] & PLACE).view(np.int64)
    if widely:
        place -= places * (place - np.arange(total) >= places)
    sizes = np.diff(ends, prepend=0)
    n_windows = np.maximum(sizes - length + 1, 0)
    parts = np.stack([n_windows, sizes - n_windows], axis=1).ravel()
    inside = np.repeat(np.tile([True, False], len(sizes)), parts)[:total]
    first = np.ones(total, bool)
    first[1:] = place[1:] != place[:-1]
    first[(ends - sizes)[n_windows > 0]] = True
    first &= inside
    start = np.flatnonzero(first)
    if not len(start):
        return Runs(none.view(np.uint64), none, none, none)
    doc = np.searchsorted(ends, start, side="right")
    stop = np.minimum(np.append(start[1:], total), ends[doc] - length + 1)
    place = place[start]
    keys = hashes_of(values, size, place) if widely else hashes[place]
    return Runs(keys, start, stop - start, doc)


#: Turns bytes and offsets into symbol hashes and the number of symbols up to each
#: document's end.
Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def byte_symbols(data: np.ndarray, offsets: np.ndarray):
    return data.astype(np.uint64), offsets[1:]


def word_symbols(data: np.ndarray, offsets: np.ndarray):
    """A hash per word; words end at white space and at the end of a document."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # the first byte of each document
    word = ~gap
    first = word.copy()
    first[1:] &= gap[:-1] | edge[1:n]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    last = word.copy()
    last[:-1] &= gap[1:] | edge[1:n]
    sizes = np.flatnonzero(last) + 1 - starts
    lead = np.zeros(starts[0], np.int64)
    from_start = np.repeat(starts, np.diff(np.append(starts, n)))
    within = np.arange(n) - np.concatenate([lead, from_start])
    value = mix(data.astype(np.uint64) | within.astype(np.uint64) << np.uint64(8))
    value[gap] = 0
    hashes = mix(np.add.reduceat(value, starts) + sizes.astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets[1:])


def _grams_of(symbols: Symbols) -> Grams:
    return byte_grams if symbols is byte_symbols else grams


def _each_slice(batch: pa.RecordBatch, symbols: Symbols) -> Iterator[tuple]:
    """Slices of a batch (doc, text, ...): first row, last row, symbols, ends, bytes, offsets."""
    data, offsets = text_bytes(batch.column(1))
    for i, j in slices(offsets, SLICE):
        part = offsets[i : j + 1] - offsets[i]
        some = data[offsets[i] : offsets[j]]
        values, ends = symbols(some, part)
        yield i, j, values, ends, some, part


def _paired(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A hash of minimizer and document. Where two of them agree by chance, a run too many is
    looked at; none is missed."""
    return mix(key ^ mix(doc.astype(np.uint64)))


#: Marks that wait in a task at most, and those of one key that are sent to its task.
MOST_MARKS = 1 << 20
MARKS_OF_KEY = 16
PACKED = "part int, keys binary, docs binary"


def _packed(part: np.ndarray, keys: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    """One row per part, with all of its keys and documents; ``part`` is in order."""
    first = np.flatnonzero(np.concatenate([[len(part) > 0], part[1:] != part[:-1]]))
    bounds = pa.py_buffer((np.append(first, len(part)) * 8).astype(np.int32))
    blobs = [
        pa.Array.from_buffers(
            pa.binary(), len(first), [None, bounds, pa.py_buffer(np.ascontiguousarray(x))]
        )
        for x in (keys, docs)
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(part[first].astype(np.int32)), *blobs], ["part", "keys", "docs"]
    )


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(part, keys, documents) of packed rows that are sorted by part."""
    held: tuple[list, list] = ([], [])
    part = None
    for batch in batches:
        for this, *blobs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if this != part and held[0]:
                yield part, *(np.frombuffer(b"".join(x), np.int64) for x in held)
                held = ([], [])
            part = this
            for x, blob in zip(held, blobs, strict=True):
                x.append(blob)
    if held[0]:
        yield part, *(np.frombuffer(b"".join(x), np.int64) for x in held)


def _times(ranked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted values: the place of each among its equals, and their number."""
    first = np.flatnonzero(np.concatenate([[len(ranked) > 0], ranked[1:] != ranked[:-1]]))
    n = np.diff(np.append(first, len(ranked)))
    return np.arange(len(ranked)) - np.repeat(first, n), np.repeat(n, n)


class _Pairs:
    """Pairs of key and document, gathered and given out as packed rows."""

    def __init__(self, bits: int):
        self.shift, self.n_parts = np.uint64(64 - bits), 1 << bits
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, keys: np.ndarray, docs: np.ndarray) -> bool:
        """Whether it is time to give them out."""
        if len(keys):
            self.held.append((keys, docs))
            self.n += len(keys)
        return self.n > MOST_MARKS

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        keys, docs = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.n = [], 0
        return keys, docs

    def by_doc(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            keys, docs = self.taken()
            part = mix(docs.view(np.uint64)) >> self.shift
            order = np.argsort(part, kind="stable")
            yield _packed(part[order].astype(np.int64), keys[order], docs[order])

    def by_key(self, found: _Pairs) -> Iterator[pa.RecordBatch]:
        """Parts of documents come after those of keys. Of a key with many marks here all but
        some go to ``found`` and there: it is known to repeat."""
        if self.n:
            keys, docs = self.taken()
            order = np.argsort(keys)
            keys, docs = keys[order], docs[order]
            nth, _ = _times(keys)
            few = nth < MARKS_OF_KEY
            if not few.all():
                found.add(keys[~few], docs[~few])
                keys, docs = keys[few], docs[few]
            part = (keys >> self.shift).astype(np.int64)
            yield _packed(part, keys.view(np.int64), docs)


def repeated_keys(
    docs: DataFrame, symbols: Symbols, length: int, gram: int, widely: bool = False
) -> tuple[DataFrame, str]:
    """(doc, keys) of documents (doc: long, text) with the minimizers that occur in two runs,
    as a written table, and its path.

    A mark is a minimizer and a document it occurs in. Marks meet by minimizer and those of
    repeated ones by document, many of them in one row of a shuffle. Of a frequent minimizer a
    task passes on the marks beyond some at once, so it is never gathered in one task.
    """
    spark = docs.sparkSession
    hashes_of = _grams_of(symbols)
    bits = min(max((4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length(), 6), 16)
    after = 1 << bits

    def moved(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            part = pa.array(row.column(0).to_numpy() + np.int32(after))
            yield pa.RecordBatch.from_arrays([part, *row.columns[1:]], row.schema.names)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, found = _Pairs(bits), _Pairs(bits)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, _, values, ends, _, _ in _each_slice(batch, symbols):
                runs = runs_of(values, ends, length, gram, hashes_of, widely)
                if marks.add(runs.key, ids[i + runs.doc]):
                    yield from marks.by_key(found)
                    if found.n > MOST_MARKS:
                        yield from moved(found.by_doc())
        yield from marks.by_key(found)
        yield from moved(found.by_doc())

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Pairs(bits)
        for part, keys, ids in _parts(batches):
            if part < after:
                order = np.argsort(keys)
                keys, ids = keys[order], ids[order]
                often = _times(keys)[1] > 1
                keys, ids = keys[often], ids[often]
            if found.add(keys, ids):
                yield from found.by_doc()
        yield from found.by_doc()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, ids in _parts(batches):
            order = np.lexsort((keys, ids))
            keys, ids = keys[order], ids[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
            keys, ids = keys[new], ids[new]
            nth, _ = _times(ids)
            first = np.flatnonzero(nth == 0)
            bounds = pa.array(np.append(first, len(ids)).astype(np.int32))
            lists = pa.ListArray.from_arrays(bounds, pa.array(keys))
            yield pa.RecordBatch.from_arrays([pa.array(ids[first]), lists], ["doc", "keys"])

    pairs = docs.select("doc", "text").mapInArrow(emit, PACKED)
    for step, schema in ((repeated, PACKED), (listed, "doc bigint, keys array<bigint>")):
        pairs = pairs.repartition("part").sortWithinPartitions("part").mapInArrow(step, schema)
    return saved_at(pairs, "run-keys")


class Once:
    """Tells which names a task meets for the first time, as far as it remembers.

    What stands behind a name needs to be written once per task. Forgetting is harmless.
    """

    MOST = 500_000

    def __init__(self):
        self.names: set[int] = set()

    def first(self, names: np.ndarray) -> np.ndarray:
        new = np.zeros(len(names), bool)
        for k, name in enumerate(names.tolist()):
            if name not in self.names:
                self.names.add(name)
                new[k] = True
        if len(self.names) > self.MOST:
            self.names.clear()
        return new


def candidates(
    docs: DataFrame,
    symbols: Symbols,
    length: int,
    gram: int,
    emitter,
    schema: str,
    label: str,
    widely: bool = False,
) -> DataFrame:
    """What ``emit(ids, tags, values, ends, bytes, offsets, runs)`` yields for the runs whose
    minimizer repeats, as a written table. ``docs`` holds doc: long, text, tag: long. Each task
    makes an ``emit`` of its own from ``emitter(Once())``."""
    keys, path = repeated_keys(docs, symbols, length, gram, widely)
    hashes_of = _grams_of(symbols)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit = emitter(Once())
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            tags = batch.column(2).to_numpy(zero_copy_only=False)
            lists = batch.column(3)
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            for i, j, values, ends, data, offsets in _each_slice(batch, symbols):
                runs = runs_of(values, ends, length, gram, hashes_of, widely)
                some = np.repeat(np.arange(j - i), np.diff(bounds[i : j + 1]))
                some = _paired(flat[bounds[i] : bounds[j]], some)
                chosen = np.isin(_paired(runs.key, runs.doc), some)
                if chosen.any():
                    yield from emit(
                        ids[i:j], tags[i:j], values, ends, data, offsets, runs.take(chosen)
                    )

    joined = docs.join(keys.withColumnRenamed("doc", "d"), F.col("doc") == F.col("d"))
    found = saved(joined.select("doc", "text", "tag", "keys").mapInArrow(read, schema), label)
    remove(docs.sparkSession, path)
    return found


def keyed(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, text, tag): ids with null before all others, texts without null, and a hash that
    tells rows of the same id apart."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    first = F.lit(-(1 << 63)).cast("long")
    return docs.select(
        F.coalesce(F.col(f"`{doc}`").cast("long"), first).alias("doc"),
        body.alias("text"),
        F.xxhash64(body).alias("tag"),
    )
