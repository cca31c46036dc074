"""Byte strings that documents share, from a suffix array built by difference cover.

The text is cut into pieces: stretches of windows that can repeat (``runs``), each with the
bytes its last window reaches into. Equal pieces are one text with the smallest document id
as owner. The suffixes of all distinct pieces are sorted as far as the match length goes:

1. Suffixes at places 1 and 2 modulo 3 are the sample. Each gets the triple of the letters
   from its place on; sorting the triples gives names in order.
2. While the names reach less far than a match, the triples of names at a distance of the
   reach are named again: the same step on the string of names.
3. The remaining suffixes are sorted by (byte, name of the next suffix) and merged into the
   sample; any two suffixes compare by one or two bytes and the names behind them.
4. Neighbours in the merged order that agree in ``length`` bytes are one class, and its
   smallest owner is where the string starts first.

Equal strings have equal minimizers. So the pieces go, run by run, to the task of their
minimizer, and each task sorts the suffixes of a bounded amount of text with whole
minimizers in it (``sort_within``). What one minimizer brings together is not bounded; above
``MOST_TOGETHER`` bytes its runs are set apart, equal ones become one by a partial aggregation,
and the different ones are sorted as before. Those of a minimizer that has more than
``MOST_TOGETHER`` bytes even then are sorted by Spark (``sort_across``): triples are named over
range partitions, and ranges of prefixes are merged on their own.

Defined results: null texts are empty; a null id counts as smaller than all others; rows with
the same id do not count as earlier than each other; strings do not cross documents; all
columns of the input are kept by ``remove_shared``; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import runs as rn
from tripweave.llm.frames import bounded_batches, free_name, saved, slices

LENGTH = 50
GRAM = 16
LETTER = 17
#: Bytes whose suffixes one task sorts at once, and those above which Spark sorts them. A sort
#: takes some 100 bytes of memory a byte.
TOGETHER = 1 << 18
MOST_TOGETHER = 4 << 20
#: Rows that wait to be passed on at most.
MOST_ROWS = 50_000
#: Runs that a piece spans at most; on average four, as every fourth minimizer ends one.
MOST_RUNS = 32
#: Suffixes that one task merges, about, and bytes whose suffixes are in one Arrow batch.
TASK_ROWS = 400_000
BATCH_TEXT = 1 << 16
PIECES = "a bigint, b bigint, doc bigint, tag bigint, start int, content binary"


def _emit(length: int, once: rn.Once):
    def emit(ids, tags, values, ends, data, offsets, runs) -> Iterator[pa.RecordBatch]:
        n = len(runs.key)
        new = np.ones(n, bool)
        follows = runs.start[1:] == runs.start[:-1] + runs.count[:-1]
        new[1:] = ~follows | (runs.doc[1:] != runs.doc[:-1]) | (runs.key[1:] & np.uint64(3) == 0)
        first = np.flatnonzero(new)
        nth = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        first = np.flatnonzero(new | (nth % MOST_RUNS == 0))
        last = np.append(first[1:], n) - 1
        start, doc = runs.start[first], runs.doc[first]
        stop = runs.start[last] + runs.count[last] + length - 1
        sizes = stop - start
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)
        content = data[np.repeat(start, sizes) + place]
        names = []
        for seed in (1, 2):
            at = place.astype(np.uint64) << np.uint64(8)
            mixed = rn.mix(content.astype(np.uint64) | at | np.uint64(seed << 60))
            names.append(rn.mix(np.add.reduceat(mixed, bounds[:-1]) + sizes.astype(np.uint64)))
        fresh = once.first(names[0])  # the bytes of a piece go out once per task
        content = np.ascontiguousarray(content[np.repeat(fresh, sizes)])
        bounds = np.concatenate([[0], np.cumsum(sizes * fresh)]).astype(np.int32)
        valid = pa.py_buffer(np.packbits(fresh, bitorder="little"))
        blobs = pa.Array.from_buffers(
            pa.binary(), len(first), [valid, pa.py_buffer(bounds), pa.py_buffer(content)]
        )
        places = (start - offsets[:-1][doc]).astype(np.int32)
        columns = [names[0].view(np.int64), names[1].view(np.int64), ids[doc], tags[doc], places]
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, columns), blobs], ["a", "b", "doc", "tag", "start", "content"]
        )

    return emit


def _named(rows: DataFrame, by: list[str], n_tasks: int) -> DataFrame:
    """(a, b, at, name): names in the order of the columns ``by``, equal for equal values."""
    width = len(by)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, before, count = TaskContext.get().partitionId() << 32, None, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for k in range(3, 3 + width):
                column = batch.column(k)
                differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
                new[1:] |= differs.to_numpy(zero_copy_only=False)
            head = [batch.column(k)[0].as_py() for k in range(3, 3 + width)]
            new[0] = head != before
            before = [batch.column(k)[-1].as_py() for k in range(3, 3 + width)]
            names = here + count + np.cumsum(new)
            count = int(names[-1] - here)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(names)], ["a", "b", "at", "name"]
            )

    sorted_rows = rows.repartitionByRange(n_tasks, *by).sortWithinPartitions(*by)
    return saved(
        sorted_rows.select("a", "b", "at", *by).mapInArrow(
            number, "a bigint, b bigint, at int, name bigint"
        ),
        "suffix-names",
    )


def _by_piece(names: DataFrame) -> DataFrame:
    """(a, b, names): the sampled places of each piece with their names, in order."""
    return names.groupBy("a", "b").agg(
        F.sort_array(F.collect_list(F.struct("at", "name"))).alias("names")
    )


def _sample(pieces: DataFrame, length: int, letter: int, n_tasks: int) -> DataFrame:
    """Names of the sampled suffixes that reach at least ``length`` bytes."""
    reach = 3 * letter

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _slices(batches, 2):
            sizes = np.diff(offsets)
            # the names behind a window reach two places beyond its start
            stops = np.maximum(sizes - length + 3, 0) if reach >= length else sizes
            piece, at = np.repeat(np.arange(len(sizes)), stops), _stretches(0 * stops, stops)
            piece, at = piece[at % 3 != 0], at[at % 3 != 0]
            letters = np.minimum(sizes[piece] - at, reach)
            triples = _binary(data[_stretches(offsets[piece] + at, letters)], letters)
            a, b = (batch.column(k).to_numpy()[piece] for k in range(2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.array(at.astype(np.int32)), triples],
                ["a", "b", "at", "triple"],
            )

    names = _named(
        pieces.select("a", "b", "content").mapInArrow(
            cut, "a bigint, b bigint, at int, triple binary"
        ),
        ["triple"],
        n_tasks,
    )

    def again(step: int):
        def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b, pairs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    name = {p["at"]: p["name"] for p in pairs}
                    places = list(name)
                    columns = [[name.get(i + k * step, -1) for i in places] for k in range(3)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([a] * len(places), pa.int64()),
                            pa.array([b] * len(places), pa.int64()),
                            pa.array(places, pa.int32()),
                            *[pa.array(c, pa.int64()) for c in columns],
                        ],
                        ["a", "b", "at", "x", "y", "z"],
                    )

        return triples

    while reach < length:
        rows = _by_piece(names).mapInArrow(
            again(reach), "a bigint, b bigint, at int, x bigint, y bigint, z bigint"
        )
        names = _named(rows, ["x", "y", "z"], n_tasks)
        reach *= 3
    return names


def _slices(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple]:
    """Some rows of a batch after the other, with the bytes of column ``k`` and their offsets."""
    for batch in batches:
        texts = batch.column(k).cast(pa.large_binary())
        buffers = texts.buffers()
        bounds = np.frombuffer(buffers[1], np.int64)[texts.offset :][: len(texts) + 1]
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
        for i, j in slices(bounds, BATCH_TEXT):
            part = bounds[i : j + 1]
            yield batch.slice(i, j - i), data[part[0] : part[-1]], part - part[0]


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(data)]
    )


MERGE_SCHEMA = (
    "a bigint, b bigint, at int, owner bigint, prefix binary, own bigint, one bigint, two bigint"
)


def _comparable(length: int):
    """Rows (a, b, content, owner, names) to one row per window with its keys of comparison.

    ``own`` is a sampled suffix's name, ``one`` its first byte and the name behind it, ``two``
    its first two bytes and the name behind them; a key that would need a name outside the
    sample is -1.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _slices(batches, 2):
            n = np.diff(offsets) - length + 1
            piece, at = np.repeat(np.arange(len(n)), n), _stretches(0 * n, n)
            pairs = batch.column(4)
            names_at, names = (pairs.flatten().field(k).to_numpy() for k in range(2))
            of = np.repeat(np.arange(len(n)), np.diff(pairs.offsets.to_numpy()))
            inside = names_at < n[of] + 2
            first = np.cumsum(n + 2) - n - 2
            name = np.full((n + 2).sum(), -1, np.int64)
            name[(first[of] + names_at)[inside]] = names[inside]
            packed, here = name.view(np.uint64), first[piece] + at
            # a window of one byte may end its piece
            text, start = np.append(data, np.uint8(0)).astype(np.uint64), offsets[piece] + at
            sort = at % 3
            one = text[start] << np.uint64(48) | packed[here + 1]
            two = text[start] << np.uint64(56) | text[start + 1] << np.uint64(48) | packed[here + 2]
            sizes = np.full(len(at), length)
            a, b, owner = (batch.column(k).to_numpy()[piece] for k in (0, 1, 3))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(a),
                    pa.array(b),
                    pa.array(at.astype(np.int32)),
                    pa.array(owner),
                    _binary(data[_stretches(start, sizes)], sizes),
                    pa.array(np.where(sort == 0, -1, name[here])),
                    pa.array(np.where(sort == 2, np.uint64(0), one).view(np.int64)),
                    pa.array(np.where(sort == 1, np.uint64(0), two).view(np.int64)),
                ],
                ["a", "b", "at", "owner", "prefix", "own", "one", "two"],
            )

    return rows


def merged_order(sort: np.ndarray, own: np.ndarray, one: np.ndarray, two: np.ndarray):
    """The suffix order of a range: ``sort`` is the place modulo 3."""
    place = np.zeros(len(sort), np.int64)
    zero, first, second = (np.flatnonzero(sort == k) for k in range(3))
    sample = np.flatnonzero(sort != 0)
    place[sample[np.argsort(own[sample])]] = np.arange(len(sample))
    order = np.argsort(one[zero])
    ones, zero = one[zero][order], zero[order]
    place[zero] = np.arange(len(zero)) + np.searchsorted(np.sort(one[first]), ones)
    twos = np.argsort(two[zero])
    place[zero[twos]] += np.searchsorted(np.sort(two[second]), two[zero][twos])
    of = first[np.argsort(one[first])]
    place[of] += np.searchsorted(ones, one[of])
    of = second[np.argsort(two[second])]
    place[of] += np.searchsorted(two[zero][twos], two[of])
    return np.argsort(place)


def _first_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges a range and compares neighbours; yields windows that start in an earlier document."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts).combine_chunks()
    at, owner, own = (rows.column(n).to_numpy() for n in ("at", "owner", "own"))
    one, two = (rows.column(n).to_numpy().view(np.uint64) for n in ("one", "two"))
    order = merged_order(at % 3, own, one, two)
    prefix = rows.column("prefix").combine_chunks()
    width = len(prefix[0].as_py())
    text = np.frombuffer(prefix.buffers()[2], np.uint8)[: width * len(at)].reshape(-1, width)
    if prefix.offset:
        text = text[prefix.offset :]
    fixed = np.ascontiguousarray(text).view(f"V{width}").ravel()[order]
    heads = np.flatnonzero(np.concatenate([[True], fixed[1:] != fixed[:-1]]))
    sizes = np.diff(np.append(heads, len(order)))
    least = np.repeat(np.minimum.reduceat(owner[order], heads), sizes)
    found = order[least < owner[order]]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(rows.column("a").to_numpy()[found]),
            pa.array(rows.column("b").to_numpy()[found]),
            pa.array(at[found]),
        ],
        ["a", "b", "at"],
    )


def _dense(values: np.ndarray) -> np.ndarray:
    """Ranks from 1 on; equal values have equal ranks."""
    order = np.argsort(values)
    ranked = values[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    ranks = np.empty(len(order), np.uint64)
    ranks[order] = np.cumsum(new).astype(np.uint64)
    return ranks


class Suffixes:
    """The suffixes of some texts, sorted by difference cover as far as ``length`` bytes."""

    def __init__(self, texts: list[bytes], length: int, letter: int = 7):
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        self.data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
        self.text = np.repeat(np.arange(len(texts)), sizes)
        self.at = np.arange(len(self.data)) - np.repeat(ends - sizes, sizes)
        self.left = np.repeat(ends, sizes) - np.arange(len(self.data))  # bytes to the end
        self.length, letter = length, min(letter, length, 7)
        self.letters, self.width = self._letters(letter), letter
        names, reach = _dense(self.letters), letter
        while reach < length:
            names, reach = self._named(names, reach), 3 * reach
        self.names = names

    def behind(self, values: np.ndarray, step: int) -> np.ndarray:
        """What stands ``step`` bytes on in the same text; zero beyond its end."""
        moved = np.zeros_like(values)
        n = max(len(values) - step, 0)
        np.multiply(values[step:], self.left[:n] > step, out=moved[:n])
        return moved

    def _letters(self, width: int) -> np.ndarray:
        """``width`` bytes from each place on as one number; nine bits tell bytes from no byte."""
        byte = self.data + np.uint64(1)
        letters = np.zeros(len(byte), np.uint64)
        for k in range(width):
            letters = letters << np.uint64(9) | self.behind(byte, k)
        return letters

    def _named(self, values: np.ndarray, step: int) -> np.ndarray:
        """Names from 1 on, in order, of the triples of the sampled places; zero elsewhere.

        The names that reach far enough are needed up to two places behind a window's start.
        """
        sampled = self.at % 3 != 0
        if 3 * step >= self.length:
            sampled &= self.left >= self.length - 2
        sample = np.flatnonzero(sampled)
        names = np.zeros(len(values), np.uint64)
        if not len(sample):
            return names
        triple = [values[sample]] + [self.behind(values, k * step)[sample] for k in (1, 2)]
        if int(values.max()) < 1 << 21:
            packed = triple[0] << np.uint64(42) | triple[1] << np.uint64(21) | triple[2]
            names[sample] = _dense(packed)
            return names
        order = np.lexsort(triple[::-1])
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([t[order][1:] != t[order][:-1] for t in triple])
        names[sample[order]] = np.cumsum(new).astype(np.uint64)
        return names

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """The places of all windows in suffix order, and where a new string starts there."""
        windows = np.flatnonzero(self.left >= self.length)
        byte, next_byte = self.data, self.behind(self.data, 1)
        one = byte << np.uint64(48) | self.behind(self.names, 1)
        two = byte << np.uint64(56) | next_byte << np.uint64(48) | self.behind(self.names, 2)
        parts = (x[windows] for x in (self.at % 3, self.names, one, two))
        order = windows[merged_order(*parts)]
        new = np.zeros(len(order), bool)
        new[:1] = True
        for k in (*range(0, self.length - self.width, self.width), self.length - self.width):
            letters = self.letters[order + k]
            new[1:] |= letters[1:] != letters[:-1]
        return order, new


RUNS = "key bigint, a bigint, b bigint, at int, owner bigint, text binary"
NAMES = ["key", "a", "b", "at", "owner", "text"]
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
FOUND_SCHEMA = "a bigint, b bigint, places array<int>, many boolean"
#: What the rows of a key with too many bytes have besides, if they are wanted.
WHOLE_SCHEMA = "key bigint, at int, owner bigint, text binary"


def _stretches(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``first``, ``first + 1``, ... of each stretch, one stretch after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(sizes.sum())


def sort_within(length: int, most: int, whole: bool = False):
    """Windows that start in a smaller owner, from rows (key, a, b, at, owner, text) sorted by
    key. Rows of a key with more than ``most`` bytes come out marked ``many``, with all of their
    columns if ``whole``.

    Equal texts of a key are one text, and all windows of those with a larger owner are found;
    suffixes are sorted where a key has texts that differ.
    """

    def sure_rows(a: np.ndarray, b: np.ndarray, places: pa.Array) -> pa.RecordBatch:
        empty = pa.RecordBatch.from_arrays([pa.nulls(len(a), k) for k in KINDS], NAMES)
        return _rows(a, b, places, False, empty if whole else None)

    def many_rows(rows: pa.RecordBatch | pa.Table) -> Iterator[pa.RecordBatch]:
        parts = rows.to_batches() if isinstance(rows, pa.Table) else [rows]
        for part in parts:
            a, b = part.column(1), part.column(2)
            yield _rows(a, b, _none(part.num_rows), True, part if whole else None)

    def sorted_texts(texts: pa.Array, least: np.ndarray, row_text, a, b, at):
        """Windows of different texts of whole keys; ``row_text`` is the text of each row."""
        suffixes = Suffixes(texts.to_pylist(), length)
        order, new = suffixes.classes()
        heads, owner = np.flatnonzero(new), least[suffixes.text[order]]
        sizes = np.diff(np.append(heads, len(order)))
        first = np.repeat(np.minimum.reduceat(owner, heads), sizes)
        place = np.sort(order[first < owner])
        text, where = suffixes.text[place], suffixes.at[place]
        cuts = np.searchsorted(text, np.arange(len(texts) + 1))
        n = np.diff(cuts)[row_text]
        some = np.flatnonzero(n)
        if len(some):
            n, row_text = n[some], row_text[some]
            places = where[_stretches(cuts[row_text], n)] + np.repeat(at[some], n)
            yield sure_rows(a[some], b[some], _lists(np.cumsum(n), places))

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Whole keys."""
        key, a, b, at, owner = (rows.column(k).to_numpy() for k in range(5))
        texts = rows.column(5).combine_chunks().dictionary_encode()
        codes, texts = texts.indices.to_numpy(), texts.dictionary
        sizes = pc.binary_length(texts).to_numpy()[codes].astype(np.int64)
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        starts, group = np.flatnonzero(new), np.cumsum(new) - 1
        many = np.add.reduceat(sizes, starts) > most
        if many.any():
            yield from many_rows(rows.take(pa.array(np.flatnonzero(many[group]))))
        # Where all owners are the same, none is smaller.
        ours = ~many & (
            np.minimum.reduceat(owner, starts) < np.maximum.reduceat(owner, starts)
        )
        index = np.flatnonzero(ours[group])
        if not len(index):
            return
        order = index[np.argsort(group[index] * len(texts) + codes[index])]
        key_of, code = group[order], codes[order]
        new = np.ones(len(order), bool)
        new[1:] = (key_of[1:] != key_of[:-1]) | (code[1:] != code[:-1])
        heads, text = np.flatnonzero(new), np.cumsum(new) - 1
        least = np.minimum.reduceat(owner[order], heads)
        larger = owner[order] > least[text]
        copies = order[larger]
        if len(copies):
            n = sizes[copies] - length + 1
            places = _stretches(at[copies].astype(np.int64), n)
            yield sure_rows(a[copies], b[copies], _lists(np.cumsum(n), places))
        differ = np.bincount(key_of[heads], minlength=len(starts)) > 1
        kept = np.flatnonzero(differ[key_of[heads]])  # texts that are sorted
        if not len(kept):
            return
        first = order[~larger & differ[key_of]]
        number = np.cumsum(differ[key_of[heads]]) - 1
        row_text = number[text[~larger & differ[key_of]]]
        ends = np.cumsum(sizes[order[heads[kept]]])
        kept_key = key_of[heads[kept]]
        begin = 0
        while begin < len(kept):
            before = ends[begin - 1] if begin else 0
            stop = int(np.searchsorted(ends, before + TOGETHER)) + 1
            if stop < len(kept):  # the rest of its last key
                stop = int(np.searchsorted(kept_key, kept_key[stop - 1], side="right"))
            i, j = np.searchsorted(row_text, (begin, stop))
            some = first[i:j]
            yield from sorted_texts(
                texts.take(pa.array(code[heads[kept[begin:stop]]])),
                least[kept[begin:stop]],
                row_text[i:j] - begin,
                *(x[some] for x in (a, b, at)),
            )
            begin = stop

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[pa.RecordBatch] = []  # whole keys
        held: list[pa.RecordBatch] = []  # rows of the last key, which may go on
        ready_rows = held_bytes = 0
        passing = None  # a key above ``most`` whose rows are passed on
        for batch in batches:
            keys = batch.column(0).to_numpy()
            if passing is not None and len(keys):
                n = int(np.searchsorted(keys != passing, True))  # its rows come first
                if n:
                    yield from many_rows(batch.slice(0, n))
                batch, keys = batch.slice(n), keys[n:]
            if not len(keys):
                continue
            passing = None
            alone = np.zeros(len(keys), bool)  # the only row of its key
            alone[1:-1] = (keys[1:-1] != keys[:-2]) & (keys[1:-1] != keys[2:])
            batch = batch.filter(pa.array(~alone))
            keys = batch.column(0).to_numpy()
            if held and held[-1].column(0)[-1].as_py() != keys[0]:
                ready += held
                ready_rows += sum(map(len, held))
                held, held_bytes = [], 0
            changes = np.flatnonzero(keys[1:] != keys[:-1])
            cut = int(changes[-1]) + 1 if len(changes) else 0
            if cut:
                ready += [*held, batch.slice(0, cut)]
                ready_rows += sum(map(len, held)) + cut
                held, held_bytes = [], 0
            held.append(batch.slice(cut))
            held_bytes += pc.sum(pc.binary_length(held[-1].column(5))).as_py()
            if held_bytes > most:
                for part in held:
                    yield from many_rows(part)
                passing, held, held_bytes = keys[-1], [], 0
            if ready_rows > MOST_ROWS:
                yield from work(pa.Table.from_batches(ready))
                ready, ready_rows = [], 0
        if ready or held:
            yield from work(pa.Table.from_batches([*ready, *held]))

    return found


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    bounds = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values.astype(np.int32)))


def _none(n: int) -> pa.Array:
    return pa.array([[]] * n, pa.list_(pa.int32()))


def _rows(a, b, places: pa.Array, many: bool, rest=None) -> pa.RecordBatch:
    """``rest``: rows with the columns of ``WHOLE_SCHEMA``, which come last."""
    a, b = (x if isinstance(x, pa.Array) else pa.array(x) for x in (a, b))
    columns = [a, b, places, pa.array(np.full(len(a), many))]
    names = ["a", "b", "places", "many"]
    if rest is not None:
        names += ["key", "at", "owner", "text"]
        columns += [rest.column(NAMES.index(x)) for x in names[4:]]
    return pa.RecordBatch.from_arrays(columns, names)


def _runs_of_pieces(length: int, gram: int):
    """Rows (a, b, content, owner) to one row per run: key, a, b, place, owner, bytes."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 4096):
                batch = whole.slice(first, 4096)
                texts = batch.column(2).to_pylist()
                ends = np.cumsum([len(t) for t in texts])
                data = np.frombuffer(b"".join(texts), np.uint8)
                runs = rn.runs_of(data.astype(np.uint64), ends, length, gram, rn.byte_grams, True)
                at = (runs.start - np.concatenate([[0], ends[:-1]])[runs.doc]).astype(np.int32)
                stops = at + runs.count + length - 1
                cut = [texts[d][i:j] for d, i, j in zip(runs.doc, at, stops, strict=True)]
                a, b, owner = (batch.column(k).to_numpy()[runs.doc] for k in (0, 1, 3))
                columns = [runs.key.view(np.int64), a, b, at, owner]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(cut, pa.binary())],
                    ["key", "a", "b", "at", "owner", "text"],
                )

    return split




def _sorted(runs: DataFrame, length: int, label: str) -> tuple[DataFrame, DataFrame]:
    """(a, b, places) of the runs whose minimizers have few bytes, and the other runs."""
    work = sort_within(length, MOST_TOGETHER, True)
    found = saved(
        runs.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(work, f"{FOUND_SCHEMA}, {WHOLE_SCHEMA}"),
        label,
    )
    return found.filter(~F.col("many")).select("a", "b", "places"), found.filter("many").select(*NAMES)


def shared_windows(pieces: DataFrame, length: int, gram: int, letter: int) -> DataFrame:
    """(a, b, places): windows of the distinct pieces (a, b, content, owner) that also start in
    a piece of a smaller owner."""
    runs = pieces.select("a", "b", "content", "owner").mapInArrow(
        _runs_of_pieces(length, gram), RUNS
    )
    sure, many = _sorted(runs, length, "suffix-classes")
    if not many.isEmpty():
        sure = sure.unionByName(windows_of_many(many, length, letter))
    places = F.array_distinct(F.flatten(F.collect_list("places")))
    return sure.groupBy("a", "b").agg(F.sort_array(places).alias("places"))


def windows_of_many(runs: DataFrame, length: int, letter: int) -> DataFrame:
    """The same of runs whose minimizers have many bytes. All windows of a run are found if an
    equal one has a smaller owner; the others are looked for in the distinct runs."""
    # two hashes stand for the text of a run
    x, y = F.xxhash64("text"), F.xxhash64(F.lit(1), "text")
    texts = saved(
        runs.groupBy("key", "text")
        .agg(F.min("owner").alias("owner"))
        .select("key", x.alias("a"), y.alias("b"), F.lit(0).alias("at"), "owner", "text"),
        "suffix-runs",
    )
    sure, many = _sorted(texts, length, "suffix-run-classes")
    if not many.isEmpty():
        left = many.select("a", "b", F.col("text").alias("content"), "owner")
        across = sort_across(left, length, letter).groupBy("a", "b")
        sure = sure.unionByName(across.agg(F.collect_list("at").alias("places")))
    owners = texts.select("a", "b", F.col("owner").alias("least")).join(sure, ["a", "b"], "left")
    owners = owners.withColumnsRenamed({"a": "x", "b": "y"})
    n = F.length("text") - (length - 1)
    rows = runs.select("a", "b", "at", "owner", n.alias("n"), x.alias("x"), y.alias("y"))
    place = (
        F.when(F.col("owner") > F.col("least"), F.expr("sequence(at, at + n - 1)"))
        .otherwise(F.expr("transform(places, p -> p + at)"))
        .alias("places")
    )
    return rows.join(owners, ["x", "y"]).select("a", "b", place).filter("places IS NOT NULL")


def sort_across(pieces: DataFrame, length: int, letter: int) -> DataFrame:
    """(a, b, at): the same windows, found by sorting all suffixes in Spark."""
    spark = pieces.sparkSession
    windows = pieces.agg(F.sum(F.length("content") - (length - 1))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_tasks = max(least, -(-windows // TASK_ROWS))
    names = _by_piece(_sample(pieces, length, letter, n_tasks))
    whole = pieces.join(names, ["a", "b"], "left").select(
        "a",
        "b",
        "content",
        "owner",
        F.coalesce("names", F.array().cast("array<struct<at:int,name:bigint>>")).alias("names"),
    )
    ranges = whole.mapInArrow(_comparable(length), MERGE_SCHEMA).repartitionByRange(
        n_tasks, "prefix"
    )
    return ranges.mapInArrow(_first_owners, "a bigint, b bigint, at int")


def shared_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, letter: int = LETTER
) -> DataFrame:
    """(doc, tag, spans) of each document's windows that start in a smaller document.

    A span is a place, a number of windows from there on, and a list of single windows.
    """
    found = rn.candidates(
        docs,
        rn.byte_symbols,
        length,
        gram,
        lambda once: _emit(length, once),
        PIECES,
        "suffix-pieces",
        True,
    )
    pieces = saved(
        found.groupBy("a", "b").agg(
            F.max("content").alias("content"), F.min("doc").alias("owner")
        ),
        "suffix-texts",
    )
    n_windows = (F.length("content") - (length - 1)).alias("n")
    places = found.select("a", "b", "doc", "tag", "start")
    owners = pieces.select("a", "b", "owner", n_windows).join(
        shared_windows(pieces, length, gram, letter), ["a", "b"], "left"
    )
    copied = F.col("doc") > F.col("owner")
    span = F.struct(
        "start",
        F.when(copied, F.col("n")).otherwise(0).alias("n"),
        F.when(copied, F.array().cast("array<int>")).otherwise(F.col("places")).alias("places"),
    )
    return (
        places.join(owners, ["a", "b"])
        .filter(copied | F.col("places").isNotNull())
        .groupBy("doc", "tag")
        .agg(F.collect_list(span).alias("spans"))
    )


def covered(n: int, spans, length: int) -> np.ndarray:
    """Which of ``n`` bytes a span's windows cover."""
    change = np.zeros(n + 1, np.int64)
    for s in spans:
        start = s["start"]
        if s["n"]:
            change[start] += 1
            change[start + s["n"] - 1 + length] -= 1
        else:
            at = np.asarray(s["places"]) + start
            np.add.at(change, at, 1)
            np.add.at(change, at + length, -1)
    return np.cumsum(change[:-1]) > 0


def remove_shared(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    letter: int = LETTER,
    name: str = "deduped",
) -> DataFrame:
    """``docs`` with a struct column ``name``: n_bytes, n_removed, n_spans and kept (bytes)."""
    bounded_batches(docs.sparkSession)
    d, t, s = (free_name(docs, c) for c in ("_doc", "_tag", "_spans"))
    spans = shared_spans(rn.keyed(docs, doc, text), length, gram, letter).select(
        F.col("doc").alias(d), F.col("tag").alias(t), F.col("spans").alias(s)
    )

    @F.pandas_udf("struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept:binary>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, found in batches:
            rows = []
            for body, spans_of in zip(texts, found, strict=True):
                data = body.encode()
                if spans_of is None or not len(spans_of):
                    rows.append((len(data), 0, 0, data))
                    continue
                gone = covered(len(data), spans_of, length)
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((len(data), int(gone.sum()), n_spans, kept))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    key_of = F.coalesce(F.col(f"`{doc}`").cast("long"), F.lit(-(1 << 63)).cast("long"))
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    joined = docs.join(spans, (key_of == F.col(d)) & (F.xxhash64(body) == F.col(t)), "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, cut(body, F.col(s)).alias(free_name(docs, name)))
