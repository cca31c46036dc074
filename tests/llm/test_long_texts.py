"""Texts that are far longer than usual, next to a copy of themselves."""

import pytest

from tripweave.llm import (
    bpe,
    decontaminate,
    html_text,
    line_dedup,
    quality_rules,
    simhash,
    substring_dedup,
    suffix_array,
    warc,
)

N = 60_000
LONG = " ".join(f"w{i * i % 7919}x{i}" for i in range(N))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "s", LONG), (2, "s", LONG), (3, "s", "short")]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_repeats_of_long_texts(docs):
    words = substring_dedup.remove_repeats(docs).select("doc_id", "deduped.n_removed").collect()
    assert dict(map(tuple, words)) == {1: 0, 2: N, 3: 0}
    data = suffix_array.remove_shared(docs).select("doc_id", "deduped.n_removed", "deduped.n_spans")
    assert {r[0]: r[1:] for r in data.collect()} == {1: (0, 0), 2: (len(LONG), 1), 3: (0, 0)}


def test_filters_on_long_texts(spark, docs):
    judged = {r["doc_id"]: r["ledger"] for r in quality_rules.ledger(docs).collect()}
    assert judged[1]["n_words"] == N and judged[1]["failed"] == 0
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == [1, 3]
    item = spark.createDataFrame([(7, LONG[300_000:300_200])], "item_id long, text string")
    found = decontaminate.find_leaks(docs, item).collect()
    assert {(r["doc_id"], r["start"], r["distance"]) for r in found} == {(1, 300_000, 0), (2, 300_000, 0)}


def test_long_pages(spark, tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    assert len(bpe.vocabulary(path).encode(LONG)) > 4 * N
    assert html_text.main_text(f"<article><p>{LONG}</p></article>") == LONG
    pages = spark.createDataFrame([(1, "u", LONG), (2, "u", LONG)], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    read = {r["record_type"]: r for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert bytes(read["response"]["payload"]).decode() == LONG
    assert read["revisit"]["payload_length"] == len(LONG)
