"""Repeated word sequences against a brute-force count."""

import random

import numpy as np
import pytest

from tripweave.llm import runs as rn
from tripweave.llm import frames, substring_dedup
from tripweave.llm.queries import op5_substring_dedup
from tests.conftest import SF_DIR


def brute(rows, length):
    """(id, n_words, n_removed, kept) by looking every window up; rows in any order."""
    seen = {}
    split = [((-1e18 if i is None else i), (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for at in range(len(words) - length + 1):
            key = tuple(words[at : at + length])
            seen[key] = min(seen.get(key, (i, at)), (i, at))
    out = []
    for (i, words), (real, _) in zip(split, rows, strict=True):
        gone = set()
        for at in range(len(words) - length + 1):
            if seen[tuple(words[at : at + length])] < (i, at):
                gone.update(range(at, at + length))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        out.append((real, len(words), len(gone), kept))
    return sorted(out, key=repr)


def ours(df, **options):
    result = substring_dedup.remove_repeats(df, **options)
    rows = result.select("doc_id", "deduped.n_words", "deduped.n_removed", "deduped.text").collect()
    return sorted([tuple(r) for r in rows], key=repr)


def random_rows(seed, n=60):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdé") for _ in range(12)] for _ in range(4)]
    rows = []
    for i in rng.sample(range(1000), n):
        words = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.4:
                words += rng.choice(passages)[rng.randint(0, 4) : rng.randint(5, 12)]
            else:
                words += [rng.choice("abcde") * rng.randint(1, 9) for _ in range(rng.randint(1, 9))]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    return rows


@pytest.mark.parametrize("length, gram", [(3, 1), (4, 2), (6, 6)])
def test_random_documents(spark, length, gram):
    for seed in range(2):
        rows = random_rows(seed) + [(2000, "a " * 300), (2001, "b"), (2002, "a " * 299 + "c")]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert ours(df, length=length, gram=gram) == brute(rows, length)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    text = "one two three four five six"
    rows = [(5, text, 1), (5, text, 1), (None, text, 2), (7, None, 3), (8, "", 4), (9, text, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, deduped int")
    out = substring_dedup.remove_repeats(df, length=3, gram=2)
    assert out.columns == ["doc_id", "text", "deduped", "deduped_"]
    got = sorted([(r[0], r["deduped_"]["n_removed"]) for r in out.collect()], key=repr)
    assert got == sorted([(5, 6), (5, 6), (None, 0), (7, 0), (8, 0), (9, 6)], key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ours(df) == []


def test_paths_name_their_source(spark):
    shared = " ".join(f"w{i}" for i in range(100))
    rows = [(1, "x y " + shared), (2, shared + " z"), (3, "q " + shared)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = substring_dedup.remove_repeats(df).select("doc_id", "deduped.paths").collect()
    assert {r[0]: [list(p) for p in r[1]] for r in out} == {
        1: [],
        2: [[0, 81, 1, 2]],
        3: [[1, 81, 1, 2]],
    }


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet")
            .select("doc_id", "text").collect()]
    expected = [r[:3] for r in brute(rows, 20)]
    got = op5_substring_dedup(spark, SF_DIR).select("doc_id", "n_words", "n_removed").collect()
    assert sorted([tuple(r) for r in got], key=repr) == sorted(expected, key=repr)
    assert sum(r[2] for r in expected) > 0


def test_symbols_of_words_and_windows():
    texts = [b"", b" a bb\ta ", b"a", b"bb", b"\n"]
    offsets = np.cumsum([0, *map(len, texts)])
    values, ends = rn.word_symbols(np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert ends.tolist() == [0, 3, 4, 5, 5]
    assert values[0] == values[2] == values[3] and values[1] == values[4] != values[0]
    numbers = rn.mix(np.arange(60, dtype=np.uint64) % 7)
    for n in (1, 3, 6, 20):
        named = rn.grams(numbers, n)
        assert len(set(named.tolist())) == 7 and named[0] == named[7]
        assert rn.least(numbers, n).tolist() == [min(numbers[i : i + n]) for i in range(61 - n)]


def test_batches_of_texts_are_bounded(spark):
    spark.conf.unset(frames.BATCH)
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id long, text string")
    try:
        assert substring_dedup.remove_repeats(docs, length=2, gram=1).count() == 2
        assert int(spark.conf.get(frames.BATCH)) == frames.BATCH_BYTES
    finally:
        spark.conf.unset(frames.BATCH)
