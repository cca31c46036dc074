"""Periodic runs, spelling variants and shards against brute force, and their edge cases."""

import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tripweave.llm import periodic_runs, sharding, spelling
from tripweave.llm.queries import QUERIES

# --- periodic runs ---------------------------------------------------------------


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def check_runs(texts):
    for text, (n, runs, left) in zip(texts, periodic_runs.runs_of(texts), strict=True):
        words = text.split()
        expected = plain_runs(words)
        gone = {k for s, size, q in expected for k in range(s + q, s + size)}
        assert (n, runs) == (len(words), expected)
        assert left == b" ".join(w for k, w in enumerate(words) if k not in gone)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc ", max_size=60), max_size=4))
def test_runs_of_any_words(texts):
    check_runs([" ".join(t).encode() for t in texts])


@pytest.mark.parametrize("letters", [2, 3, 20])
def test_runs_of_periodic_words(letters):
    rng = random.Random(letters)
    texts = []
    for _ in range(150):
        part = [str(rng.randrange(letters)) for _ in range(rng.randint(1, 12))]
        body = part * rng.randint(1, 9) + part[: rng.randrange(len(part) + 1)]
        noise = [str(rng.randrange(letters)) for _ in range(rng.randint(0, 9))]
        texts.append(" ".join(noise + body + noise[::-1] + body).encode())
    check_runs(texts)


def test_a_wrong_hash_is_noticed(monkeypatch):
    """With a hash that holds all stretches equal at first, the runs are still the right ones."""
    seeds = []
    real = periodic_runs.Hashes.same

    class Lying(periodic_runs.Hashes):
        def __init__(self, words, seed):
            super().__init__(words, seed)
            self.seed = seed
            seeds.append(seed)

        def same(self, at, period, size):
            return size >= 0 if self.seed == 0 else real(self, at, period, size)

    monkeypatch.setattr(periodic_runs, "Hashes", Lying)
    check_runs([b"a b a b a b a b c a b c x y a a a a a a a b"])
    assert max(seeds) > 0


def test_runs_as_a_column(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a b " * 5, "x"), (3, "a b " * 5, "x"), (4, "a a " * 6, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `periodic` string")
    found = periodic_runs.with_runs(docs)
    assert found.columns == ["doc_id", "text", "periodic", "periodic_"]
    got = [(r[0], r[3]["n_words"], [tuple(x) for x in r[3]["runs"]], r[3]["collapsed"]) for r in found.collect()]
    assert got == [
        (1, 0, [], ""),
        (2, 0, [], ""),
        (3, 10, [(0, 10, 2)], "a b"),
        (3, 10, [(0, 10, 2)], "a b"),
        (4, 6, [(0, 6, 1)], "a a"),
    ]
    assert periodic_runs.with_runs(docs.limit(0)).count() == 0


def test_long_texts_of_one_word_and_of_many():
    n = 200_000
    (count, runs, left), = periodic_runs.runs_of([b"a " * n])
    assert (count, runs, left) == (n, [(0, n, 1)], b"a")
    (count, runs, left), = periodic_runs.runs_of([b" ".join(b"%d" % (i % 9973) for i in range(n))])
    assert (count, runs) == (n, [(0, n, 9973)])


def test_query_of_runs(spark):
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    some = 0
    for row in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", texts[row["doc_id"]]) if w]
        n, h = len(words), zlib.crc32(str(row["doc_id"]).encode())
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        some += bool(runs)
    assert some > 5


# --- spelling --------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_groups(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    best = {w: min(x, key=lambda y: (-counts[y], y)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if counts[b] >= 5 * counts[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {
        w: (n, len(near[w]), form.get(w), counts.get(form.get(w)), root(w)) for w, n in counts.items()
    }


def grouped(spark, counts, partitions=4):
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(partitions)
    found = spelling.group_variants(table).select("word", "n", "n_near", "form", "form_n", "root")
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return {r[0]: r[1:] for r in rows}


def some_words(rng, n, letters, least, most):
    words = set()
    while len(words) < n:
        words.add("".join(rng.choice(letters) for _ in range(rng.randint(least, most))))
    return {w: 5 ** rng.randrange(6) + rng.randrange(3) for w in sorted(words)}


def test_groups_equal_brute_force(spark):
    rng = random.Random(3)
    counts = some_words(rng, 250, "ab", 6, 8) | some_words(rng, 150, "abé\U00010348", 6, 7)
    assert grouped(spark, counts) == plain_groups(counts)


def test_tiles_of_a_hot_bucket(spark, monkeypatch):
    """Nearly all words begin alike and fill many tiles; the blocks of pairs are cut, too."""
    monkeypatch.setattr(spelling, "TILE", 7)
    monkeypatch.setattr(spelling, "PAIRS", 11)
    rng = random.Random(4)
    counts = {f"common{w}": n for w, n in some_words(rng, 120, "abc", 3, 5).items()}
    counts |= some_words(rng, 30, "ab", 6, 9)
    assert grouped(spark, counts, 1) == plain_groups(counts)


def test_chains_ties_and_empty_tables(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "zzzzzz": 9, "aaaaaac": 25}
    got = grouped(spark, counts)
    assert got == plain_groups(counts)
    assert got["aaaaaa"][2] == "aaaaaac" and got["aaaaab"][4] == "aaabbb"
    assert grouped(spark, {"lonely": 5}) == {"lonely": (5, 0, None, None, "lonely")}
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.group_variants(empty).count() == 0
    nulls = spark.createDataFrame([(None, 7), ("single", 5)], "word string, n long")
    assert [r["word"] for r in spelling.group_variants(nulls).collect()] == ["single"]


def test_very_long_words(spark):
    long = "ab" * 30_000
    counts = {long: 50, long[:-1] + "x": 5, long + "y": 6, long[1:] + "qq": 5}
    assert grouped(spark, counts) == plain_groups(counts)


def test_words_and_counts(spark):
    text = "HÉLLO Öffnung ×÷abcdef, ab-cdefgh ABCDEFG'abcdefg"
    rows = spark.createDataFrame([(text, "a"), (None, "b"), ("", "c")], "t string, word string")
    words = rows.select(F.explode(spelling.words_of(F.col("t"), 6)).alias("w"))
    assert sorted(r[0] for r in words.collect()) == ["abcdefg", "abcdefg", "cdefgh", "Öffnung", "×÷abcdef"]
    assert spelling.count_words(words, "w", 6, 2).collect() == [("abcdefg", 2)]


def test_query_of_spelling(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    rows = QUERIES["op12_spelling_variants"](spark, SF_DIR).collect()
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert got == plain_groups(counts) and len(rows) == len(counts)


# --- sharding --------------------------------------------------------------------


def sharded(spark, rows, path, keys=("id", "text"), shards=8):
    loads = sharding.slot_loads(rows, keys, "size")
    first = sharding.save_map(sharding.first_map(spark, shards), f"{path}/map", 1)
    second = sharding.save_map(sharding.rebalanced(first, loads, shards), f"{path}/map", 2)
    sharding.write_shards(rows, second, keys, f"{path}/rows")
    return loads, first, second, sharding.read_shards(rows, f"{path}/rows")


def numbered_without_gaps(rows, shard="shard", slot="slot"):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r[shard], []).append(r[slot])
    return all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_bytes_are_near_equal(spark, tmp_path):
    n, large = 20_000, 30_000
    size = F.when(F.col("id") % 997 == 0, large).otherwise(F.col("id") % 2000 + 1).cast("long")
    rows = spark.range(n).withColumn("size", size).withColumn("text", F.repeat(F.lit("x"), 3))
    loads, first, second, read = sharded(spark, rows, str(tmp_path))
    found = read.collect()
    assert sorted(r["id"] for r in found) == list(range(n)) and numbered_without_gaps(found)
    total = Counter()
    for r in found:
        total[r["shard"]] += r["size"]
    assert set(total) == set(range(8)) and max(total.values()) - min(total.values()) < 1000
    assert {tuple(r) for r in sharding.load_map(spark, f"{tmp_path}/map").collect()} == {
        tuple(r) for r in second.collect()
    }
    assert sharding.load_map(spark, f"{tmp_path}/map", 1).exceptAll(first).count() == 0
    assert 0 < sharding.moves(first, second).count() < sharding.SLOTS / 4
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        sharding.save_map(first, f"{tmp_path}/map", 2)


def test_one_more_shard_takes_rows_only_into_itself(spark, tmp_path):
    rows = spark.range(5000).withColumn("size", F.col("id") % 900 + 1).withColumn("text", F.lit(None).cast("string"))
    loads, _, second, _ = sharded(spark, rows, str(tmp_path))
    third = sharding.grown(second, loads, 8)
    assert {r["to_shard"] for r in sharding.moves(second, third).collect()} == {8}
    held = loads.join(third, "slot").groupBy("shard").agg(F.sum("n_bytes").alias("b")).collect()
    sizes = [r["b"] for r in held]
    assert len(sizes) == 9 and max(sizes) < 1.1 * min(sizes)
    again = sharding.rebalanced(third, loads, 9)
    assert third.count() == again.count() == again.select("slot").distinct().count() == sharding.SLOTS


def test_nulls_repeats_clashes_and_empty_tables(spark, tmp_path):
    data = [(None, None, None, "a", "s")] * 3 + [(1, "t", 5, "b", "s")] * 2 + [(2, "", 1, None, None)]
    rows = spark.createDataFrame(data, "id long, text string, size long, shard string, `_metadata` string")
    read = sharded(spark, rows, str(tmp_path / "a"))[3]
    assert read.columns == [*rows.columns, "shard_", "slot"]
    found = read.collect()
    assert Counter(tuple(r)[:5] for r in found) == Counter(data) and numbered_without_gaps(found, "shard_")
    assert sharded(spark, rows.limit(0), str(tmp_path / "b"))[3].count() == 0


def test_query_of_shards(spark):
    texts = {r[0]: (r[1] or "").encode() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    query = QUERIES["op13_sharding"](spark, SF_DIR)
    assert "Python" not in query._jdf.queryExecution().toString()
    rows = query.collect()
    assert numbered_without_gaps(rows) and len(rows) == len(texts)
    total = Counter()
    for r in rows:
        body = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"]) == (len(body) + 1, zlib.crc32(body))
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
        total[r["shard"]] += r["size"]
    assert set(total) == set(range(8)) and max(total.values()) < 1.05 * min(total.values())
