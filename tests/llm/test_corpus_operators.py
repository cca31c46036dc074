"""Line dedup, decontamination, SimHash, WARC, and the pipeline."""

import gzip
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import compare, connect
from tests.conftest import SF_DIR
from tests.test_oracle import SPARK_TO_DUCK
from tripweave.llm import components, decontaminate, frames, line_dedup, simhash, warc
from tripweave.llm.oracle import ORACLE
from tripweave.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    duck = connect(SF_DIR)
    df = QUERIES[name](spark, SF_DIR)
    ours, theirs = compare(df, duck, ORACLE[name])
    assert ours == theirs
    types = {c[0]: str(c[1]) for c in duck.execute(ORACLE[name]).description}
    assert {c: SPARK_TO_DUCK[t] for c, t in df.dtypes} == types


COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"

# --- lines -----------------------------------------------------------------------

LINES = "doc_id long, source string, text string, _lines int"


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_lines_of_a_site(spark, monkeypatch, broadcast):
    monkeypatch.setattr(line_dedup, "MOST_BROADCAST", broadcast)
    rows = [(i, "a", f"menu\nbody {i}\n menu \n\nend {i % 2}", 0) for i in range(40)]
    rows += [(100 + i, None, f"menu\nx{i}", 0) for i in range(40)]
    rows += [(200 + i, "small", "menu", 0) for i in range(5)]
    rows += [(300, "a", None, 0), (301, "a", "", 0), (302, "a", "other\n\nother", 0)]
    rows += [rows[0]]
    df = spark.createDataFrame(rows, LINES)
    out = line_dedup.drop_boilerplate(df, ratio=0.6, dropped="gone")
    assert out.columns == [*df.columns, "gone"]
    got = {(r["doc_id"], r["text"], r["gone"]) for r in out.collect()}
    assert out.count() == len(rows)
    assert (0, "body 0\n\nend 0", 2) in got and (105, "x5", 1) in got
    assert {(200, "menu", 0), (300, None, 0), (301, "", 0), (302, "other\n\nother", 0)} <= got
    half = line_dedup.drop_boilerplate(df, ratio=0.4).filter("doc_id = 1").first()["text"]
    assert half == "body 1\n"
    assert line_dedup.drop_boilerplate(df.limit(0)).count() == 0


def test_sites_of_any_size_and_their_copies(spark):
    """The commonest line goes at every site, content stays, copies are one page."""
    rows = []
    for size in (4, 19, 20, 50, 400):
        site = f"s{size}"
        for i in range(size):
            lines = [f"body {i} of {site}"]
            if i < max(3, size * 8 // 100 + 1):  # just above the ratio
                lines.append("boilerplate")
            if size >= 50 and i % 20 == 0:  # a twentieth of the pages
                lines.append("common")
            rows.append((len(rows), site, "\n".join(lines), 0))
        rows += [(1000 + len(rows) + k, site, f"copy\nof {site}", 0) for k in range(size // 2)]
    rows += [(5000 + i, "two", f"menu\nbody {i}", 0) for i in range(2)]
    df = spark.createDataFrame(rows, LINES)
    texts = {r["doc_id"]: (r["source"], r["text"]) for r in line_dedup.drop_boilerplate(df).collect()}
    assert len(texts) == len(rows)
    for i, site, before, _ in rows:
        after = "\n".join(x for x in before.split("\n") if x != "boilerplate")
        assert texts[i] == (site, after)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_copies_at_a_site_keep_their_content(spark, tmp_path):
    rng = random.Random(11)
    copied = "\n".join(prose(rng, 40) for _ in range(6))
    texts = [copied] * 7 + [copied + " " + prose(rng, 1)] * 3  # equal and near copies
    texts += [f"{prose(rng, 200)}\nmenu of the site\n{prose(rng, 60)}" for _ in range(20)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    item = spark.createDataFrame([(1, "nothing of this is in any of the documents")], "item_id long, text string")
    item.write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert out == {0: copied} | {
        i: t.replace("menu of the site\n", "") for i, t in enumerate(texts) if i >= 10
    }


def test_small_sites_lose_what_they_repeat(spark):
    rng = random.Random(12)
    rows = []
    for site, n, with_menu in [("six", 6, 6), ("three", 3, 3), ("two", 2, 2), ("nine", 9, 2)]:
        for k in range(n):
            body = prose(rng, 150)
            rows.append((len(rows), ("menu\n" if k < with_menu else "") + body, "en", site, body))
    rows += [(100 + i, "menu\n" + rows[0][4], "en", "copies", "menu\n" + rows[0][4]) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, body string")
    out = corpus_pipeline.line_dedup_stage(spark, docs.withColumn("n_chars", F.lit(0)), SF_DIR)
    wrong = [r for r in out.collect() if r["text"] != (
        r["body"] if r["source"] in ("six", "three") else rows[r["doc_id"]][1] if r["doc_id"] < 100 else r["body"])]
    assert wrong == []


# --- decontamination -------------------------------------------------------------


def edit_distance(pattern, text):
    """Smallest distance of the pattern to any substring."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row, best = new, min(best, new[-1])
    return best


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        chars[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "yz"])
    return "".join(chars)


@pytest.mark.parametrize("block", [4 << 20, 200])
def test_leaks_equal_the_full_distance(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 6)))
    items = [(i, " ".join(word() for _ in range(12))) for i in range(6)]
    items += [(6, None), (7, "short"), (8, items[0][1]), (None, items[1][1]), (9, "Is it\tshort?")]
    docs = []
    for i in range(60):
        body = " ".join(word() for _ in range(rng.randint(0, 30)))
        if i % 2:
            body += " \n" + edited(rng, items[i % 6][1], rng.randint(0, 8)).upper() + " " + word()
        docs.append((i, body))
    docs += [(60, None), (61, ""), (1, docs[1][1]), (None, items[2][1])]
    docs += [(62, "so: is it  short? yes"), (63, "this it short?"), (64, "is it short?er"), (65, "is it shor?")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r[0], r[1]): r[2] for r in decontaminate.find_leaks(frame, bench, rate=0.1).collect()}
    expected = {}
    for i, body in docs:
        for k, item in items:
            item = decontaminate.plain(item or "")
            text = decontaminate.plain(body or "")
            if item.count(" ") < 2:
                continue
            if len(item) < decontaminate.LEAST_CHARS:
                if re.search(rf"(?<!\w){re.escape(item)}(?!\w)", text):
                    expected[i, k] = 0
                continue
            distance = edit_distance(item, text)
            if distance <= int(len(item) * 0.1):
                expected[i, k] = distance
    # a mark at the end of an item is a border of its own
    expected[64, 9] = 0
    assert got == expected and (62, 9) in got and (1, None) in got
    assert [r["item_id"] for r in decontaminate.not_searched(bench).collect()] == [6, 7]
    kept = decontaminate.drop_leaking(frame, bench, rate=0.1)
    flagged = {i for i, _ in expected}
    assert sorted((r[0] for r in kept.collect()), key=repr) == sorted(
        (i for i, _ in docs if i not in flagged), key=repr
    )
    assert decontaminate.find_leaks(frame, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(frame.limit(0), bench).count() == 0


def test_leak_query_equals_plain_search(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    got = QUERIES["op6_benchmark_decontamination"](spark, SF_DIR).collect()
    exact = {
        (d["doc_id"], i["item_id"]) for d in docs for i in items
        if decontaminate.plain(i["text"]) in decontaminate.plain(d["text"] or "")
    }
    assert {(r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0} == exact
    texts = {d["doc_id"]: decontaminate.plain(d["text"]) for d in docs}
    for r in got:
        item = next(i["text"] for i in items if i["item_id"] == r["item_id"])
        found = texts[r["doc_id"]][r["start"] : r["end"]]
        assert edit_distance(decontaminate.plain(item), found) == r["distance"]


# --- simhash ---------------------------------------------------------------------


def plain_fingerprint(text, width):
    words = [w.lower() for w in text.encode().split()]
    n = max(len(words) - width + 1, 1) if words else 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def roots_of(prints, distance):
    """Component of each fingerprint by comparing all of them."""
    values = sorted(set(prints))
    array, root = np.array(values, np.uint64), {}
    for start in values:
        if start in root:
            continue
        stack = [start]
        root[start] = start
        while stack:
            near = np.bitwise_count(array ^ np.uint64(stack.pop())) <= distance
            for v in array[near].tolist():
                if v not in root:
                    root[v] = start
                    stack.append(v)
    return root


def test_fingerprints_have_no_shortcuts():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 5, 300, 1200):
        text = "".join(rng.choice(["A", "bé", " ", "\t\n", "Ä "]) for _ in range(n))
        assert simhash.fingerprint(text, 4) == plain_fingerprint(text, 4)


@pytest.mark.parametrize("distance, hot", [(4, 4000), (4, 18), (3, 30), (1, 4000)])
def test_links_equal_all_pairs(spark, monkeypatch, distance, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = random.Random(distance)
    centers = [rng.getrandbits(64) for _ in range(40)] + [0]
    prints = []
    for c in centers:
        for _ in range(rng.choice([1, 2, 5, 60])):
            flips = rng.sample(range(64), rng.randint(0, 5))
            prints.append(c ^ sum(1 << b for b in flips))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in set(prints)]
    df = spark.createDataFrame(signed, "fp long").repartition(4)
    links = simhash.links(df, distance).collect()
    for a, b in links:
        assert a > b and bin((a ^ b) & (1 << 64) - 1).count("1") <= distance
    found = components.components(spark.createDataFrame(links or [(1, 0)], "a long, b long"))
    ours = {n & (1 << 64) - 1: r & (1 << 64) - 1 for n, r in found.collect()} if links else {}
    groups, expected = {}, {}
    for v, r in roots_of(prints, distance).items():
        expected.setdefault(r, set()).add(v)
    for v in set(prints):
        groups.setdefault(ours.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("batch", [64, 10_000])
def test_hot_buckets_are_cut_until_none_is_left(spark, monkeypatch, batch):
    """All fingerprints agree in most bits; buckets are larger than a batch and than the bound."""
    monkeypatch.setattr(simhash, "HOT", 40)
    sizes = []
    spread = simhash._spread
    monkeypatch.setattr(simhash, "_spread", lambda f, d: sizes.append(len(f)) or spread(f, d))
    rng = random.Random(batch)
    prints = {rng.getrandbits(17) << 20 | rng.getrandbits(2) << 62 for _ in range(1500)}
    masks = simhash.segments(2)
    rows, links = [(b, None, v) for v in prints for b in range(64)], set()
    while rows:
        keyed = []
        for bit, mask, v in rows:
            own = simhash._segment_of(bit, masks) & ~(1 << bit) if mask is None else mask
            keyed.append((bit, *([] if mask is None else [mask]), v & own, v))
        signed = [[x - (1 << 64) if x >> 63 else x for x in r] for r in sorted(keyed)]
        signed.sort()
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part, strict=True)],
                                       [str(k) for k in range(len(part[0]))])
            for part in (signed[k : k + batch] for k in range(0, len(signed), batch))
        ]
        n_keys, rows = len(signed[0]) - 1, []
        for found in simhash._linker(masks, 2, n_keys, simhash.HOT)(iter(batches)):
            for bit, mask, a, b in zip(*(c.to_pylist() for c in found.columns), strict=True):
                unsigned = tuple(x & (1 << 64) - 1 for x in (mask, a, b))
                if bit >= 0:
                    rows.append((bit, unsigned[0], unsigned[1]))
                else:
                    links.add(unsigned[1:])
        assert len(rows) == len(set(rows))
    assert max(sizes) <= 2 ** (2 * 2 + 2)
    root = {v: v for v in prints}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in links:
        assert bin(a ^ b).count("1") <= 2
        a, b = sorted((top(a), top(b)))
        root[b] = a
    assert {v: top(v) for v in prints} == roots_of(prints, 2)


def test_one_of_a_group_under_odd_column_names(spark):
    rows = [(2, "one two three four", 1), (1, "one two three four", 2), (3, "else", 3)]
    for doc, text in (("doc.id", "te xt"), ("fingerprint", "component_id"), ("fp", "copies")):
        df = spark.createDataFrame(rows, "a long, b string, c long").toDF(doc, text, "n")
        kept = simhash.keep_one(df, doc=doc, text=text)
        assert kept.columns == df.columns
        assert sorted(r[0] for r in kept.collect()) == [1, 3]


def test_heavy_keys_are_looked_up_like_others(spark):
    rows = [(7, k) for k in range(3000)] + [(k, k) for k in range(100, 2100)]
    df = spark.createDataFrame(rows, "key long, v long")
    names = df.groupBy("key").agg(F.count("*").alias("n")).withColumn("name", F.col("key") * 2)
    out = frames.looked_up(df, "key", names, len(rows))
    assert sorted(map(tuple, out.collect())) == sorted((k, v, 2 * k) for k, v in rows)
    assert frames.looked_up(df.limit(0), "key", names.limit(0), 0).count() == 0


def test_groups_with_nulls_and_repeats(spark):
    text = "one two three four five six"
    rows = [(3, text), (1, text.upper()), (3, text), (None, text), (7, None), (8, " \n"), (9, "other words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_gone", F.lit(1))
    out = simhash.near_groups(df)
    got = sorted([(r[0], r[2]) for r in out.collect()], key=repr)
    assert got == sorted([(3, 1), (1, 1), (3, 1), (None, 1), (7, 7), (8, 7), (9, 9)], key=repr)
    assert out.filter("doc_id = 8").first()["fingerprint"] == "0" * 16
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted([r[0] for r in kept.collect()], key=repr) == sorted([1, None, 7, 9], key=repr)
    assert simhash.near_groups(df.limit(0)).count() == 0


def test_simhash_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    prints = {i: plain_fingerprint(t or "", 4) for i, t in docs}
    root, least = roots_of(prints.values(), 4), {}
    for i, p in prints.items():
        least[root[p]] = min(least.get(root[p], i), i)
    expected = sorted((i, f"{p:016x}", least[root[p]]) for i, p in prints.items())
    got = QUERIES["op9_simhash_near_dedup"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == expected


def test_long_chains_are_one_component(spark):
    rng = random.Random(3)
    names = list(range(400))
    rng.shuffle(names)
    pairs = list(zip(names, names[1:], strict=False)) + [(1000, 1001)]
    links = [(max(p), min(p)) for p in pairs] * 2
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert dict(map(tuple, found)) == {n: 0 for n in range(1, 400)} | {1001: 1000}


# --- archives --------------------------------------------------------------------

PAGES = "page_id long, url string, html string, digest int"


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_archives_read_back(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(warc, "MOST_BROADCAST", broadcast)
    trap = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "http://a\r\nX: y", "same", 0), (5, None, "same", 0), (5, None, "same", 0),
            (None, "u", "same", 0), (2, "", None, 0), (3, "é", trap, 0), (4, "x", "\r\n\r\né", 0)]
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(2), path)
    read = warc.read_archives(spark, path)
    assert warc.quarantined(read).count() == 0
    got = sorted(
        [(warc_id(r["record_id"]), r["record_type"], warc_id(r["refers_to"]), text(r["payload"]),
          r["payload_length"], r["target_uri"]) for r in warc.records(read).collect()], key=repr)
    assert got == sorted(
        [(1, "revisit", 5, None, 4, "http://a%0D%0AX: y"), (5, "response", None, "same", 4, None),
         (5, "response", None, "same", 4, None), (None, "revisit", 5, None, 4, "u"),
         (2, "response", None, "", 0, None), (3, "response", None, trap, len(trap), "é"),
         (4, "response", None, "\r\n\r\né", 6, "x")], key=repr)


def warc_id(name):
    return int(name[10:-1]) if name and name[10:-1] else None


def text(payload):
    return None if payload is None else bytes(payload).decode()


def test_short_payloads_stay_whole(spark, tmp_path):
    rows = [(i, "u", "tiny", 0) for i in range(3)] + [(9, "u", "a longer text", 0), (8, "u", "a longer text", 0)]
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(rows, PAGES), path, least_bytes=5)
    kinds = warc.records(warc.read_archives(spark, path)).groupBy("record_type").count().collect()
    assert dict(map(tuple, kinds)) == {"response": 4, "revisit": 1}


def test_no_pages_no_records(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.read_archives(spark, path).count() == 0


def test_long_urls_read_back(spark, tmp_path):
    rows = [(1, "data:" + "x" * 200_000, "a", 0), (2, "\x01" * 70_000, "b", 0), (3, "u", "c", 0)]
    warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), str(tmp_path / "w"))
    read = warc.read_archives(spark, str(tmp_path / "w")).cache()
    assert warc.quarantined(read).count() == 0
    got = {warc_id(r["record_id"]): (r["target_uri"], text(r["payload"])) for r in warc.records(read).collect()}
    assert got == {1: (rows[0][1], "a"), 2: ("%01" * 70_000, "b"), 3: ("u", "c")}


def record(payload: bytes) -> bytes:
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: {len(payload)}\r\n" \
           f"WARC-Block-Digest: sha1:{warc.sha1_base32(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


@pytest.mark.parametrize("pack", [lambda r: r, gzip.compress])
def test_damaged_archives_are_salvaged(pack):
    parts = [pack(record(f"payload number {i} ".encode() * 20)) for i in range(5)]
    rng = random.Random(7)
    for broken in range(5):
        for _ in range(20):
            damaged = list(parts)
            part = bytearray(damaged[broken])
            if rng.random() < 0.5:
                part = part[: rng.randrange(1, len(part))]
            else:
                at = rng.randrange(len(part) // 2, len(part) - 10)
                part[at] ^= 0x55
            damaged[broken] = bytes(part)
            data = b"".join(damaged)
            found = list(warc.salvage(data))
            whole = {bytes(r["payload"])[15:16] for r in found if r["kind"] == "record"}
            assert {str(i).encode() for i in range(5) if i != broken} <= whole
            covered = sorted((r["start"], r["end"]) for r in found)
            assert covered[0][0] == 0 and covered[-1][1] == len(data)
            assert all(a[1] == b[0] for a, b in zip(covered, covered[1:], strict=False))


def test_records_of_one_member_are_salvaged(monkeypatch):
    rng = random.Random(9)
    parts = [record(f"{i} {prose(rng, 3_000)}".encode()) for i in range(3)]
    middle = bytearray(parts[1])
    middle[len(middle) // 2] ^= 0x55
    damaged = gzip.compress(parts[0] + bytes(middle) + parts[2])
    whole, alone = gzip.compress(b"".join(parts)), gzip.compress(record(b"3 alone"))
    no_digest = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 2\r\n\r\n4 \r\n\r\n"
    stored = gzip.compress(b"".join(parts), 0)  # version lines stand in the compressed bytes
    flipped = bytearray(whole)
    flipped[-6] ^= 0x55
    for chunk in (1 << 16, 100):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        for data, expected, reason in [
            (damaged, "02", "inflated bytes"),
            (whole[: len(whole) * 5 // 6], "01", "member"),
            (bytes(flipped), "012", "member"),
            (gzip.compress(parts[0] + no_digest)[:-4], "0", "member"),
            (stored[:-8], "012", "member"),
        ]:
            found = list(warc.salvage(data + alone))
            assert "".join(chr(r["payload"][0]) for r in found if r["kind"] == "record") == expected + "3"
            (gap,) = [r for r in found if r["kind"] == "gap"]
            assert reason in gap["reason"]
            ranges = sorted({(r["start"], r["end"]) for r in found})
            assert ranges[0][0] == 0 and ranges[-1][1] == len(data + alone)
            assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_garbage_is_one_gap(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"noise " * 100 + record(b"x") + b"\x1f\x8b\x08tail")
    read = warc.read_archives(spark, str(tmp_path))
    assert [bytes(r["payload"]) for r in warc.records(read).collect()] == [b"x"]
    gaps = warc.quarantined(read).orderBy("start").collect()
    assert [(r["start"], r["n_bytes"]) for r in gaps] == [(0, 600), (600 + len(record(b"x")), 7)]


# --- pipeline --------------------------------------------------------------------


def test_stages_keep_their_contract(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup",
                     "benchmark_decontamination", "bpe"]
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR).cache()
        assert after.columns == docs.columns
        docs = after
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] > sizes[4] > 0
    run = corpus_pipeline.run(spark, SF_DIR)
    assert run.count() == sizes[4]
    ours = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: r["text"] for r in run.collect()} == ours


def test_pipeline_takes_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0


def test_archives_stay_small_whatever_the_pages_are(spark, tmp_path, monkeypatch):
    """Large pages share an archive with few others; all come back."""
    monkeypatch.setattr(warc, "SIZES", ((0, 50), (1_000, 4), (20_000, 1)))
    rows = [(i, "u" * (900 if i == 7 else 3), "x" * (30_000 if i % 40 == 0 else 1_500 if i % 4 == 0 else 10) + str(i)) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    sizes = [p.stat().st_size for p in (tmp_path / "w").glob("part-*")]
    assert max(sizes) < 60_000 and len(sizes) > 15
    read = warc.records(warc.read_archives(spark, path)).collect()
    assert sorted((warc_id(r["record_id"]), bytes(r["payload"]).decode()) for r in read) == [
        (i, html) for i, _, html in rows
    ]
    assert warc.quarantined(warc.read_archives(spark, path)).count() == 0


def test_few_links_are_few_files(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "saved", lambda df, label: written.append(f := frames.saved(df, label)) or f)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", COALESCE)}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set(COALESCE, "false")
    try:
        links = spark.createDataFrame([(i + 1, i) for i in range(200)], "a long, b long")
        found = components.components(links).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert {tuple(r) for r in found} == {(i, 0) for i in range(1, 201)}
    cores = spark.sparkContext.defaultParallelism
    assert len(written) > 2
    assert all(len(df.inputFiles()) <= cores for df in written[1:])


def test_batches_of_texts_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(6_000).select("id", F.repeat(F.lit("x"), 5_000).alias("text")).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    def largest():
        return docs.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]

    spark.conf.unset(key)
    corpus_pipeline.simhash_stage(spark, docs.limit(2).withColumnRenamed("id", "doc_id"), "")
    try:
        assert largest() < 6_000_000
        spark.conf.set(key, "1000000")  # a session's own bound stays
        frames.bounded_batches(spark)
        assert largest() < 2_000_000
    finally:
        spark.conf.unset(key)
