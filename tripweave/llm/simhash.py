"""Near duplicates by SimHash fingerprints that differ in few bits.

Fingerprints are taken over word shingles. For at most ``d`` differing bits the 64 bits are
cut into ``d // 2 + 1`` segments: one of them differs by one bit at most. Each fingerprint is
indexed under every segment with one bit struck out, rows with the same key are brought
together, and each candidate is verified by its distance.

Only distinct fingerprints are indexed, so copies cost nothing. Small buckets are compared in
whole; in larger ones a search spreads from one fingerprint to all within reach and goes on
with what it has not reached, which for a dense group is about one comparison per member,
and hands on one link per member instead of all pairs. Buckets above ``HOT`` are cut by the
pigeonhole principle before that, level by level until none is left above it or fewer than
``2 * (d + 1)`` bits are free, which bounds a bucket by ``2 ** (2 * d + 2)`` fingerprints. A task
passes the rows of a hot bucket on as they come. All links count, none is dropped.

Defined results: a null text has no words; texts without words have fingerprint zero and
link like others; texts with fewer words than a shingle have one shingle; a component is
named by the smallest id reachable, null only if all its ids are null; repeated ids give a
row each; further columns are ignored by ``near_groups`` and kept by ``keep_one``, which
never drops rows without an id and keeps or drops rows of the same id together; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.numbers import exact
from tripweave.llm.components import components
from tripweave.llm.frames import free_name, looked_up, saved

SEED = 42
#: Members up to which all pairs of a bucket are compared at once.
SMALL = 16
#: Members above which a bucket is cut into finer ones.
HOT = 4_000
FOUND = "bit int, mask bigint, a bigint, b bigint"


def fingerprint(text: str, width: int) -> int:
    """The 64-bit SimHash of a text, as an unsigned integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # A-Z and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    n = max(len(words) - width + 1, 1)
    digest, last = xxhash.xxh64_intdigest, ends[width - 1 :] or [len(joined)]
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, last, strict=False)), np.uint64, n
    )
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, n, 255):  # one byte holds the counts of a block
        block = hashes[k : k + 255].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(text: Column, width: int) -> Column:
    """The fingerprint of each text; nulls have no words."""
    return _fingerprint_udf(width)(F.coalesce(text.cast("string"), F.lit("")))


def _fingerprint_udf(width: int):
    @F.pandas_udf("bigint")
    def take(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.array([fingerprint(t, width) for t in texts], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return take


def segments(distance: int) -> list[int]:
    """Masks of the segments."""
    n = distance // 2 + 1
    cuts = [64 * k // n for k in range(n + 1)]
    return [sum(1 << b for b in range(i, j)) for i, j in zip(cuts, cuts[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _segment_of(bit: int, masks: list[int]) -> int:
    return next(m for m in masks if m >> bit & 1)


def variants(prints: DataFrame, masks: list[int]) -> DataFrame:
    """(bit, key, fp): each fingerprint under each segment with one bit struck out."""
    keep = F.array(
        *[F.lit(_signed(_segment_of(b, masks) & ~(1 << b))).cast("long") for b in range(64)]
    )
    return prints.select(F.posexplode(keep).alias("bit", "mask"), "fp").select(
        "bit", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"
    )


@lru_cache(maxsize=100_000)
def _finer(bit: int, mask: int, masks: tuple[int, ...], distance: int) -> list[int]:
    """``mask``, the bits that agree in a bucket, with each part of the free bits outside the
    segment: two fingerprints within the distance agree in one of them. Empty if few are free."""
    taken = mask | _segment_of(bit, masks)
    free = [b for b in range(64) if not taken >> b & 1]
    n = distance + 1
    if len(free) < 2 * n:
        return []
    cuts = [len(free) * k // n for k in range(n + 1)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]


def _spread(fps: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between the members of one bucket."""
    left = fps
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = np.bitwise_count(left ^ at) <= distance
            if near.any():
                found = left[near]
                left = left[~near]
                yield from ((int(at), int(f)) for f in found)
                reached.extend(found)


def _small_pairs(bit, group, fps, masks, distance):
    """Verified pairs of neighbouring rows in one group, each in one of its buckets only."""
    out = []
    for step in range(1, SMALL):
        if step >= len(fps):
            break
        same = np.flatnonzero(group[step:] == group[:-step])
        if not len(same):
            break
        x = fps[same] ^ fps[same + step]
        same, x = (v[np.bitwise_count(x) <= distance] for v in (same, x))
        own = np.zeros(len(x), np.uint64)
        # The first segment that fits decides, and of one in common its lowest bit.
        for mask in reversed(masks):
            part = x & np.uint64(mask)
            fits = np.bitwise_count(part) <= 1
            own = np.where(fits, np.where(part == 0, np.uint64(mask & -mask), part), own)
        here = np.uint64(1) << bit[same].astype(np.uint64)
        pick = same[own == here]
        out.append((pick, pick + step))
    return out


def _linker(masks: list[int], distance: int, n_keys: int, most: int):
    """Links within buckets; the rows (bit, key, fp) or (bit, mask, key, fp) come sorted by bucket.

    Links come out with bit -1. Members of buckets with more than ``most`` come out with their
    bit, once under the mask of each finer bucket.
    """
    most = max(most, SMALL)

    def finer(row: np.ndarray) -> list[int]:
        bit = int(row[0])
        mask = int(row[1]) & (1 << 64) - 1 if n_keys == 3 else _segment_of(bit, masks) & ~(1 << bit)
        return _finer(bit, mask, tuple(masks), distance)

    def hot(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        fps = np.ascontiguousarray(rows[:, -1]).view(np.uint64)
        for mask in finer(rows[0]):
            yield _found(rows[:, 0], np.full(len(fps), mask, np.uint64), fps, fps)

    def work(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        keys, fps = rows[:, :n_keys], np.ascontiguousarray(rows[:, -1]).view(np.uint64)
        new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        starts = np.concatenate([[0], new])
        sizes = np.diff(np.concatenate([starts, [len(rows)]]))
        group = np.repeat(np.arange(len(starts)), sizes)
        few = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
        small = fps[few]
        for i, j in _small_pairs(rows[few][:, 0], group[few], small, masks, distance):
            if len(i):
                yield _linked(small[i], small[j])
        for k in np.flatnonzero(sizes > SMALL):
            members = slice(starts[k], starts[k] + sizes[k])
            if sizes[k] > most and finer(rows[starts[k]]):
                yield from hot(rows[members])
                continue
            found = list(_spread(fps[members], distance))
            if found:
                yield _linked(*np.array(found, dtype=np.uint64).T)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of the last bucket, which may go on
        passing: np.ndarray | None = None  # a hot bucket whose rows are passed on
        for batch in batches:
            rows = np.stack([np.asarray(c, dtype=np.int64) for c in batch.columns], axis=1)
            if passing is not None and len(rows):
                other = np.flatnonzero((rows[:, :n_keys] != passing).any(axis=1))
                n = int(other[0]) if len(other) else len(rows)
                if n:
                    yield from hot(rows[:n])
                rows = rows[n:]
                if len(rows):
                    passing = None
            if not len(rows):
                continue
            changes = np.flatnonzero((rows[1:, :n_keys] != rows[:-1, :n_keys]).any(axis=1))
            last = int(changes[-1]) + 1 if len(changes) else 0
            goes_on = bool(held) and not (rows[0, :n_keys] != held[-1][-1, :n_keys]).any()
            if held and not goes_on:
                yield from work(np.concatenate(held))
                held = []
            if last:
                yield from work(np.concatenate([*held, rows[:last]]))
                held = []
            held.append(rows[last:])
            if sum(map(len, held)) > most and finer(held[0][0]):
                passing = held[0][0, :n_keys].copy()
                yield from hot(np.concatenate(held))
                held = []
        if held:
            yield from work(np.concatenate(held))

    return link


def _found(bit: np.ndarray, mask: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    columns = [bit.astype(np.int32), *(v.view(np.int64) for v in (mask, a, b))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bit", "mask", "a", "b"])


def _linked(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    a, b = np.ascontiguousarray(a), np.ascontiguousarray(b)
    return _found(np.full(len(a), -1), np.zeros(len(a), np.uint64), a, b)


def links(prints: DataFrame, distance: int) -> DataFrame:
    """Verified links (a > b) between distinct fingerprints that connect what is in reach."""
    masks = segments(distance)
    # A row of 8 bytes becomes 64 rows, so the shuffle before must not be packed into few tasks.
    # Another expression than the column itself, whose partitioning Spark would take over.
    n_tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = prints.repartition(n_tasks, F.xxhash64("fp"))
    rows, keys = variants(spread, masks), ["bit", "key"]
    sure = None
    while True:
        found = saved(
            rows.repartition(*keys)
            .sortWithinPartitions(*keys)
            .mapInArrow(_linker(masks, distance, len(keys), HOT), FOUND),
            "simhash-links",
        )
        level = found.filter("bit < 0").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        )
        sure = level if sure is None else sure.unionByName(level)
        hot = found.filter("bit >= 0")
        if hot.isEmpty():
            return sure.filter("a != b")
        key = F.col("a").bitwiseAND(F.col("mask")).alias("key")
        rows, keys = hot.select("bit", "mask", key, F.col("a").alias("fp")), ["bit", "mask", "key"]


def roots(prints: DataFrame, distance: int) -> DataFrame:
    """(node, root) of the distinct fingerprints ``fp`` that are linked and not roots."""
    return components(links(prints, distance))


def _groups(docs: DataFrame, doc: str, text: str, width: int, distance: int) -> DataFrame:
    """(doc, fp, component_id), one row per row of ``docs``."""
    prints = saved(
        docs.select(exact(doc).alias("doc"), fingerprints(exact(text), width).alias("fp")),
        "fingerprints",
    )
    least = prints.groupBy("fp").agg(F.min("doc").alias("least"), F.count("*").alias("copies"))
    rooted = roots(least.select("fp"), distance)
    of_print = least.join(rooted, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", "copies", F.coalesce("root", "fp").alias("root")
    )
    of_print = saved(of_print, "simhash-roots")
    of_root = of_print.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count("*").alias("n")
    )
    named = looked_up(of_print.drop("least"), "root", of_root, of_print.count())
    named = saved(named.select("fp", F.col("copies").alias("n"), "component_id"), "simhash-names")
    return looked_up(prints, "fp", named, prints.count()).select("doc", "fp", "component_id")


def near_groups(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    width: int = 4,
    distance: int = 4,
) -> DataFrame:
    """(doc, fingerprint, component_id), one row per row of ``docs``."""
    return _groups(docs, doc, text, width, distance).select(
        F.col("doc").alias(doc),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    width: int = 4,
    distance: int = 4,
) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id."""
    gone = free_name(docs, "_gone")
    dropped = (
        _groups(docs, doc, text, width, distance)
        .filter(F.col("doc") != F.col("component_id"))
        .select(F.col("doc").alias(gone))
        .distinct()
    )
    return docs.join(dropped, exact(doc) == F.col(gone), "left_anti")
