"""Repeated word sequences by compacting the de Bruijn graph of the corpus.

The windows of ``length`` words are the edges of the graph; two windows that follow each
other share the node between them. Only windows that can repeat are looked at (``runs``), in
runs that travel whole. Equal runs are counted once and keep their first source coordinate.
Within the runs of one minimizer every edge learns its first place in the corpus and
whether the nodes at its ends branch; stretches without a branch, whose sources follow one
another, compact into paths. Paths go back to all places of their run by a join, are glued
across runs where both ends are open and the source goes on, and count only if their source
coordinate lies before the place itself.

Edges are equal if the minimizer and a further 48-bit hash of the words agree. A run that a
third of the documents share is one row after the partial aggregation; what a task sees
together are the distinct surroundings of one minimizer.

Defined results: a null text has no words; a null id counts as smaller than all others; rows
with the same id never count as earlier than each other, and equal rows get equal results;
windows do not leave their document; all columns of the input are kept by ``remove_repeats``;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import runs as rn
from tripweave.llm.frames import bounded_batches, free_name, saved

LENGTH = 20
GRAM = 6
#: Bytes of an edge's own hash; with the 64 bits of its minimizer that makes 112 bits.
EDGE_BYTES = 6
RUN_SCHEMA = (
    "key bigint, content bigint, doc bigint, tag bigint, start int, edges binary"
)
PATH_SCHEMA = (
    "key bigint, content bigint, at int, n int, from_doc bigint, from_start int, "
    "open_left boolean, open_right boolean"
)
#: A path in a document, from its first window on.
SPAN = "struct<start:int,n:int,from_doc:bigint,from_start:int,open_left:boolean,open_right:boolean>"


def _emit(length: int, once: rn.Once):
    def emit(ids, tags, values, ends, data, offsets, runs) -> Iterator[pa.RecordBatch]:
        edges = rn.grams(values, length)
        firsts = np.concatenate([[0], ends[:-1]])[runs.doc]
        lasts = ends[runs.doc] - length  # place of a document's last window
        # Each run with the edges before and after it; none at the ends of a document.
        sizes = runs.count + 2
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        index = np.repeat(runs.start - 1, sizes) + place
        outside = (index < np.repeat(firsts, sizes)) | (index > np.repeat(lasts, sizes))
        packed = np.where(outside, np.uint64(0), edges[np.clip(index, 0, len(edges) - 1)])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        mixed = rn.mix(packed ^ rn.mix(place.astype(np.uint64)))
        content = rn.mix(np.add.reduceat(mixed, bounds[:-1]) + sizes.astype(np.uint64))
        new = once.first(content ^ runs.key)  # the edges of a run go out once per task
        packed = packed[np.repeat(new, sizes)].astype("<u8").view(np.uint8).reshape(-1, 8)
        packed = np.ascontiguousarray(packed[:, :EDGE_BYTES])
        places = np.concatenate([[0], np.cumsum(sizes * new) * EDGE_BYTES]).astype(np.int32)
        valid = pa.py_buffer(np.packbits(new, bitorder="little"))
        blobs = pa.Array.from_buffers(
            pa.binary(), len(sizes), [valid, pa.py_buffer(places), pa.py_buffer(packed)]
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(runs.key.view(np.int64)),
                pa.array(content.view(np.int64)),
                pa.array(ids[runs.doc]),
                pa.array(tags[runs.doc]),
                pa.array((runs.start - firsts).astype(np.int32)),
                blobs,
            ],
            ["key", "content", "doc", "tag", "start", "edges"],
        )

    return emit


def _compact(key, content, doc, start, n_seen, blobs) -> pa.RecordBatch | None:
    """Paths of whole groups of distinct runs; the rows are sorted by key."""
    sizes = np.array([len(b) // EDGE_BYTES for b in blobs]) - 2
    cut = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, EDGE_BYTES)
    packed = np.zeros((len(cut), 8), np.uint8)
    packed[:, :EDGE_BYTES] = cut
    packed = packed.view("<u8").ravel()
    bounds = np.concatenate([[0], np.cumsum(sizes + 2)])
    run = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    index = bounds[run] + 1 + at
    edge, before, after = packed[index], packed[index - 1], packed[index + 1]
    place_doc, place = doc[run], start[run] + at
    order = np.lexsort((place, place_doc, edge, key[run]))
    e, k = edge[order], key[run][order]
    new = np.ones(len(e), bool)
    new[1:] = (e[1:] != e[:-1]) | (k[1:] != k[:-1])
    heads = np.flatnonzero(new)
    group = np.empty(len(e), np.int64)
    group[order] = np.cumsum(new) - 1
    from_doc, from_place = place_doc[order][heads][group], place[order][heads][group]
    single = []
    for side in (before, after):
        s = side[order]
        low, high = np.minimum.reduceat(s, heads), np.maximum.reduceat(s, heads)
        single.append(((low == high) & (low != 0))[group])
    only_before, only_after = single
    first = at == 0
    broken = np.ones(len(e), bool)
    broken[1:] = (
        first[1:]
        | (from_doc[1:] != from_doc[:-1])
        | (from_place[1:] != from_place[:-1] + 1)
        | ~(only_after[:-1] & only_before[1:])
    )
    begin = np.flatnonzero(broken)
    stop = np.append(begin[1:], len(e)) - 1
    own = (from_doc[begin] == place_doc[begin]) & (from_place[begin] == place[begin])
    useful = ~own | (n_seen[run[begin]] > 1)
    begin, stop = begin[useful], stop[useful]
    if not len(begin):
        return None
    r = run[begin]
    last = at[stop] == sizes[r] - 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key[r]),
            pa.array(content[r]),
            pa.array(at[begin].astype(np.int32)),
            pa.array((stop - begin + 1).astype(np.int32)),
            pa.array(from_doc[begin]),
            pa.array(from_place[begin].astype(np.int32)),
            pa.array(first[begin] & only_before[begin]),
            pa.array(last & only_after[stop]),
        ],
        ["key", "content", "at", "n", "from_doc", "from_start", "open_left", "open_right"],
    )


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compacts group after group; the rows come sorted by minimizer."""
    held: list[pa.RecordBatch] = []

    def work(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts)
        if rows.num_rows:
            key, content, doc, start, seen = (
                rows.column(i).to_numpy().astype(np.int64) for i in range(5)
            )
            out = _compact(key, content, doc, start, seen, rows.column(5).to_pylist())
            if out is not None:
                yield out

    for whole in batches:
        for first in range(0, whole.num_rows, 4096):
            batch = whole.slice(first, 4096)
            keys = batch.column(0).to_numpy()
            if held and held[-1].column(0)[-1].as_py() != keys[0]:
                yield from work(held)
                held = []
            changes = np.flatnonzero(keys[1:] != keys[:-1])
            if len(changes):
                cut = int(changes[-1]) + 1
                yield from work([*held, batch.slice(0, cut)])
                held = [batch.slice(cut)]
            else:
                held.append(batch)
    if held:
        yield from work(held)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, tag, spans) of the paths in each document whose source lies earlier."""
    runs = rn.candidates(
        docs,
        rn.word_symbols,
        length,
        gram,
        lambda once: _emit(length, once),
        RUN_SCHEMA,
        "substring-runs",
    )
    distinct = runs.groupBy("key", "content").agg(
        F.min(F.struct("doc", "start")).alias("first"),
        F.count("*").alias("n_seen"),
        F.min("edges").alias("edges"),
    )
    paths = saved(
        distinct.select("key", "content", "first.doc", "first.start", "n_seen", "edges")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_paths, PATH_SCHEMA),
        "substring-paths",
    )
    places = runs.select("key", "content", "doc", "tag", "start").join(paths, ["key", "content"])
    start = F.col("start") + F.col("at")
    earlier = (F.col("from_doc") < F.col("doc")) | (
        (F.col("from_doc") == F.col("doc")) & (F.col("from_start") < start)
    )
    span = F.struct(
        start.alias("start"), "n", "from_doc", "from_start", "open_left", "open_right"
    )
    return (
        places.filter(earlier)
        .select("doc", "tag", span.cast(SPAN).alias("span"))
        .groupBy("doc", "tag")
        .agg(F.sort_array(F.collect_list("span")).alias("spans"))
    )


def glued(spans) -> list[list[int]]:
    """Paths of one document joined across runs: [start, windows, source doc, source start]."""
    out: list[list] = []
    for s in spans:
        if out:
            p = out[-1]
            follows = p[0] + p[1] == s["start"] and p[2] == s["from_doc"]
            if follows and p[4] and s["open_left"] and p[3] + p[1] == s["from_start"]:
                p[1] += s["n"]
                p[4] = s["open_right"]
                continue
        out.append([s["start"], s["n"], s["from_doc"], s["from_start"], s["open_right"]])
    return [p[:4] for p in out]


def remove_repeats(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    name: str = "deduped",
) -> DataFrame:
    """``docs`` with a struct column ``name``: n_words, n_removed, text (the kept words, joined by
    one space) and paths ([start, windows, source document, source start])."""
    bounded_batches(docs.sparkSession)
    key, names = rn.keyed(docs, doc, text), [free_name(docs, c) for c in ("_doc", "_tag", "_spans")]
    d, t, s = names
    spans = repeated_spans(key, length, gram).select(
        F.col("doc").alias(d), F.col("tag").alias(t), F.col("spans").alias(s)
    )

    @F.pandas_udf("struct<n_words:bigint,n_removed:bigint,text:string,paths:array<array<bigint>>>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, found in batches:
            rows = []
            for body, spans_of in zip(texts, found, strict=True):
                words = body.encode().split()
                n, paths = len(words), []
                if spans_of is not None and len(spans_of):
                    paths = glued(spans_of)
                    kept, at = [], 0
                    for first, count, *_ in paths:
                        kept += words[at:first]
                        at = max(at, first + count - 1 + length)
                    words = kept + words[at:]
                rows.append((n, n - len(words), b" ".join(words).decode(), paths))
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "text", "paths"])

    key_of = F.coalesce(F.col(f"`{doc}`").cast("long"), F.lit(-(1 << 63)).cast("long"))
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    joined = docs.join(spans, (key_of == F.col(d)) & (F.xxhash64(body) == F.col(t)), "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, cut(body, F.col(s)).alias(free_name(docs, name)))
