"""Shared byte strings against a brute-force count, and the merged order itself."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF_DIR
from tripweave.llm import suffix_array
from tripweave.llm.queries import op7_suffix_array_dedup


def brute(rows, length):
    """(id, n_bytes, n_removed, n_spans, kept) by looking every string up."""
    seen = {}
    split = [((-1e18 if i is None else i), (t or "").encode()) for i, t in rows]
    for i, data in split:
        for at in range(len(data) - length + 1):
            key = data[at : at + length]
            seen[key] = min(seen.get(key, i), i)
    out = []
    for (i, data), (real, _) in zip(split, rows, strict=True):
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            if seen[data[at : at + length]] < i:
                gone[at : at + length] = True
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((real, len(data), int(gone.sum()), int(spans), kept))
    return sorted(out, key=repr)


def ours(df, **options):
    rows = suffix_array.remove_shared(df, **options).select("doc_id", "deduped.*").collect()
    return sorted([(*r[:4], bytes(r[4])) for r in rows], key=repr)


def random_rows(seed, n=50):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abé\0") for _ in range(40)) for _ in range(3)]
    rows = []
    for i in rng.sample(range(1000), n):
        text = ""
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.5:
                text += rng.choice(passages)[rng.randint(0, 9) : rng.randint(9, 40)]
            else:
                text += "".join(rng.choice("abcde\n") for _ in range(rng.randint(1, 30)))
        rows.append((i, text))
    return rows


@pytest.mark.parametrize(
    "length, gram, letter, most",
    [(8, 3, 3, 0), (8, 3, 1, 0), (13, 5, 2, 0), (8, 3, 3, 8 << 20), (13, 5, 2, 60), (25, 9, 2, 60)],
)
def test_random_documents(spark, monkeypatch, length, gram, letter, most):
    monkeypatch.setattr(suffix_array, "MOST_TOGETHER", most)
    monkeypatch.setattr(suffix_array, "TOGETHER", 500)
    rows = random_rows(length + letter) + [(2000, "ab" * 200), (2001, "b"), (2002, "ab" * 150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = brute(rows, length)
    assert ours(df, length=length, gram=gram, letter=letter) == expected
    assert sum(r[2] for r in expected) > 0


def test_nulls_ties_repeats_and_clashing_columns(spark):
    text = "0123456789" * 2
    rows = [(5, text, 1), (5, text, 1), (None, text, 2), (7, None, 3), (8, "", 4), (9, text, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, deduped int")
    out = suffix_array.remove_shared(df, length=6, gram=3, letter=2)
    assert out.columns == ["doc_id", "text", "deduped", "deduped_"]
    got = sorted([(r[0], r["deduped_"]["n_removed"]) for r in out.collect()], key=repr)
    assert got == sorted([(5, 20), (5, 20), (None, 0), (7, 0), (8, 0), (9, 20)], key=repr)


def test_empty_table(spark):
    assert ours(spark.createDataFrame([], "doc_id long, text string")) == []


@pytest.mark.parametrize("length, letter", [(1, 7), (5, 1), (12, 2), (50, 7), (50, 3)])
def test_suffixes_are_in_order(length, letter):
    rng = random.Random(length)
    texts = [bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randint(0, 90))) for _ in range(30)]
    texts += [b"ab" * 60, texts[0], texts[1][:40]]
    suffixes = suffix_array.Suffixes(texts, length, letter)
    order, new = suffixes.classes()
    starts = [texts[suffixes.text[p]][suffixes.at[p] :][:length] for p in order]
    assert all(len(s) == length for s in starts)
    assert len(starts) == sum(max(len(t) - length + 1, 0) for t in texts)
    assert starts == sorted(starts)
    assert new.tolist() == [k == 0 or starts[k - 1] != s for k, s in enumerate(starts)]


def test_merge_sorts_suffixes():
    rng = random.Random(4)
    text = [rng.randrange(3) for _ in range(300)]
    suffixes = sorted(range(len(text)), key=lambda i: text[i:])
    rank = {i: k for k, i in enumerate(suffixes)}
    n = len(text) - 2
    at = np.arange(n)
    own = np.array([rank[i] if i % 3 else -1 for i in at])
    one = np.array([text[i] << 48 | rank[i + 1] for i in at], np.uint64)
    two = np.array([text[i] << 56 | text[i + 1] << 48 | rank[i + 2] for i in at], np.uint64)
    order = suffix_array.merged_order(at % 3, own, one, two)
    assert order.tolist() == [i for i in suffixes if i < n]


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet")
            .select("doc_id", "text").collect()]
    expected = [r[:4] for r in brute(rows, 50)]
    got = op7_suffix_array_dedup(spark, SF_DIR).drop("kept_sha256").collect()
    assert sorted([tuple(r) for r in got], key=repr) == sorted(expected, key=repr)
    assert sum(r[2] for r in expected) > 0


def sort_rows(rows):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    names = ["key", "a", "b", "at", "owner", "text"]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def test_keys_of_one_owner_are_not_sorted(monkeypatch):
    sorted_texts = []

    class Noted(suffix_array.Suffixes):
        def __init__(self, texts, *rest):
            sorted_texts.extend(texts)
            super().__init__(texts, *rest)

    monkeypatch.setattr(suffix_array, "Suffixes", Noted)
    rows = [(1, 1, 1, 0, 5, b"abcdef"), (1, 2, 2, 0, 5, b"abcdeg")]
    rows += [(2, 3, 3, 0, 5, b"uvwxyz"), (2, 4, 4, 7, 6, b"uvwxya"), (2, 5, 5, 9, 6, b"uvwxya")]
    found = pa.Table.from_batches(suffix_array.sort_within(4, 1 << 20)(iter([sort_rows(rows)])))
    assert sorted_texts == [b"uvwxyz", b"uvwxya"]
    places = dict(zip(found.column("a").to_pylist(), found.column("places").to_pylist(), strict=True))
    assert places == {4: [7, 8], 5: [9, 10]}


@pytest.mark.parametrize("step", [1, 3, 1000])
@pytest.mark.parametrize("most", [60, 1 << 20])
def test_windows_of_a_key_over_any_batches(monkeypatch, step, most):
    monkeypatch.setattr(suffix_array, "TOGETHER", 50)
    monkeypatch.setattr(suffix_array, "MOST_ROWS", 10)
    rng, length, rows = random.Random(step), 4, []
    for key in range(40):
        for _ in range(rng.choice([1, 2, 3, 12])):
            letters = (100 + 2 * key, 101 + 2 * key)  # equal windows have equal keys
            text = bytes(rng.choice(letters) for _ in range(rng.randrange(4, 9)))
            n = len(rows)
            rows.append((key, n, -n, rng.randrange(5), rng.randrange(4), text))
    expected, many = set(), set()
    for key in range(40):
        own = [r for r in rows if r[0] == key]
        if sum(len(r[5]) for r in own) > most:
            many |= {r[1] for r in own}
            continue
        first = {}
        for r in own:
            for i in range(len(r[5]) - length + 1):
                w = r[5][i : i + length]
                first[w] = min(first.get(w, 9), r[4])
        for r in own:
            for i in range(len(r[5]) - length + 1):
                if first[r[5][i : i + length]] < r[4]:
                    expected.add((r[1], r[3] + i))
    batches = iter([sort_rows(rows[i : i + step]) for i in range(0, len(rows), step)])
    got, got_many = [], set()
    for batch in suffix_array.sort_within(length, most)(batches):
        for a, _, places, is_many in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got_many |= {a} if is_many else set()
            got += [(a, p) for p in places]
    assert set(got) == expected and got_many == many
    assert expected and bool(many) == (most == 60)
