"""HTML extraction, BPE, chat formatting and quality rules."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SF_DIR
from tripweave.llm import bpe, chat_format, html_text, quality_rules
from tripweave.llm.queries import QUERIES, WORD_BPE

# --- html ------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>"</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, and more, and more, on this long line.</p></div>
<div id="wrap"><div class="post"><h2>Title &amp; more</h2>
<p>First, with   commas, and <b>bold</b>&nbsp;words&hellip;<p>Second <a href="#">link</a>, unclosed
<ul><li>one</li><li>two</li></ul></div>
<form><p>Your name, please, here, and there</p></form>
<div class="comments"><p>A comment, with, many, commas, in, it, and so on.</p></div></div>
<aside><p>Aside, of, some, length.</p></aside><footer><p>Footer</p></footer></body></html>"""


def test_main_text_without_the_rest():
    assert html_text.main_text(PAGE) == (
        "Title & more\nFirst, with commas, and bold words…\nSecond link, unclosed\none\ntwo"
    )


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("only text", "only text"),
        ("a &lt; b &am &#233;", "a < b &am é"),
        ("<p>x<br>y</p>", "x y"),
        ("<p title='a>b'>t", "t"),
        ("<!-- <p>no</p>", ""),
        ("<div>1 < 2</div>", "1 < 2"),
        ("</p></div><p>stray</p>", "stray"),
        ("<article><h1>H</h1><p>T</p></article>", "H\nT"),
        ("<div class='page has-sidebar'><p>T</p><div class='side-ad'><p>A</p></div></div>", "T"),
    ],
)
def test_broken_and_small_pages(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize("html", ["<a '" * 5000, "<div>" * 3000, "<" * 50_000, "<p>" * 20_000])
def test_hostile_pages_end(html):
    html_text.main_text(html + "x")


def test_pages_without_article_and_main(spark):
    """The container comes from the points of its paragraphs, whatever it is called."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").limit(60).collect()
    for page in pages:
        plain = re.sub(r"(</?)(article|main)\b", r"\1div", page["html"])
        assert html_text.main_text(plain) == html_text.main_text(page["html"]) != ""


def test_a_class_word_alone_does_not_drop_an_element():
    prose = "A sentence of some length, with commas, that reads like an article. " * 4
    page = (
        f"<body><div class='menu'><a href=x>Home</a></div><article><p>{prose}</p>"
        f"<div class='related-work'><p>Earlier {prose}</p></div>"
        f"<div class='related-posts'><p>Another page, another page, another page</p></div></article></body>"
    )
    text = html_text.main_text(page)
    assert "Earlier" in text and "Another" not in text and "Home" not in text


def test_query_ignores_other_columns(spark, tmp_path):
    rows = [(1, "u", f"<article><p>{'words, ' * 30}</p></article>", "WRONG", "X")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string, text string")
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    got = QUERIES["op1_html_extraction"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [(1, "u", ("words, " * 30).strip(), 209)]


def test_pages_with_nulls_repeats_and_clashes(spark):
    rows = [(1, None), (2, "<p>a</p>"), (2, "<p>a</p>")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    out = html_text.extract(df.withColumn("main_text", F.lit(0)))
    assert out.columns == ["page_id", "html", "main_text", "main_text_"]
    assert sorted(r["main_text_"] for r in out.collect()) == ["", "a", "a"]
    assert html_text.extract(df.limit(0)).count() == 0


def test_extraction_query(spark):
    """The pages of the test tables hold their article between article tags."""
    import html as entities
    import re

    pages = {
        r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    }
    for row in QUERIES["op1_html_extraction"](spark, SF_DIR).collect():
        page = pages[row["page_id"]]
        inside = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = (re.sub(r"<[^>]*>", " ", b) for b in re.split(r"</?(?:p|h1)>", inside))
        blocks = [" ".join(entities.unescape(b).split()) for b in blocks]
        assert row["text"] == "\n".join(b for b in blocks if b)
        assert row["n_chars"] == len(row["text"])


# --- byte-pair encoding ----------------------------------------------------------

PATH = public_tokenizers.path(WORD_BPE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def tokens(text):
    return np.frombuffer(bpe.vocabulary(PATH).encode(text), "<u4").tolist()


HARD = "a th in 's ' 1 ² é Σ İ ﬁ ẞ ǅ ا ٣ _ !! ; 漢 😀 </w> <|endoftext|> \0 \x1c \x85 ​ ͅ".split(" ")
HARD += [" ", "\n", "é", "　"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(HARD), max_size=12).map("".join))
def test_encoding_equals_the_library_on_hard_text(text):
    whole = Tokenizer.from_file(PATH) if not hasattr(tokens, "lib") else tokens.lib
    tokens.lib = whole
    ids = whole.encode(text, add_special_tokens=False).ids
    assert tokens(text) == ids
    packed = np.array(ids, "<u4").tobytes()
    assert bpe.spelling(PATH).decode(packed) == whole.decode(ids, skip_special_tokens=False)


def test_long_words_take_linear_time(library):
    rng = random.Random(1)
    text = "".join(rng.choice("etaoinshr") for _ in range(100_000))
    assert tokens(text[:3000]) == library.encode(text[:3000], add_special_tokens=False).ids
    assert len(tokens(text)) > 20_000 and len(tokens("a" * 200_000)) > 1000


def test_encoding_of_nulls_and_clashing_names(spark):
    df = spark.createDataFrame([(None, 1), ("", 2), ("the", 3)], "text string, tokens int")
    out = bpe.decode(bpe.encode(df, PATH), PATH, tokens="tokens_")
    assert out.columns == ["text", "tokens", "tokens_", "decoded"]
    rows = {r["tokens"]: (bytes(r["tokens_"]), r["decoded"]) for r in out.collect()}
    assert rows[1] == rows[2] == (b"", "") and rows[3][1] == "the</w>"
    assert bpe.encode(df.limit(0), PATH).count() == 0
    again = bpe.round_trip(df, PATH)
    assert again.columns == out.columns and sorted(again.collect(), key=repr) == sorted(
        out.collect(), key=repr
    )


def test_bpe_query_equals_the_library(spark, library):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    for row in QUERIES["op3_bpe"](spark, SF_DIR).collect():
        ids = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


# --- chats -----------------------------------------------------------------------

CHAT = "conv_id long, turn long, role string, text string, formatted int"


def test_chats_read_back(spark):
    pieces = ["\\", "### ", "</turn>", "\n", ": ", "x", "\n</turn>\n", "### user: ", "é", "$1"]
    rng = random.Random(5)
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 7))) for _ in range(300)]
    roles = ["user", "assistant", "a: b", "a\\", "\\n", "a\nb", "", ": "]
    rows = [(i % 9, i, rng.choice(roles), t, 0) for i, t in enumerate(texts)]
    chats = chat_format.format_chats(spark.createDataFrame(rows, CHAT).repartition(5))
    chats = chats.withColumn("turns", chat_format.parse(F.col("formatted")))
    chats = chats.withColumn("loss", chat_format.trained_text(F.col("runs"))).collect()
    assert len(chats) == 9
    for chat in chats:
        said = [(r[2], r[3]) for r in rows if r[0] == chat["conv_id"]]
        assert [(t["role"], t["text"]) for t in chat["turns"]] == said
        assert chat["loss"] == "".join(t for r, t in said if r == "assistant")
        spans = [chat["formatted"][s[0] - 1 : s[0] - 1 + s[1]] for s in chat["loss_spans"]]
        assert len(spans) == sum(r == "assistant" for r, _ in said)


def test_chats_with_nulls_ties_and_gaps(spark):
    rows = [(1, None, None, None, 1), (1, 5, "user", "b", 1), (1, 5, "user", "a", 1),
            (None, 0, "assistant", "x", 1), (1, 500, "user", "z", 1)]
    df = spark.createDataFrame(rows, CHAT)
    out = {r["conv_id"]: r for r in chat_format.format_chats(df).collect()}
    assert out[1]["formatted"] == "".join(
        f"### {r}: {t}\n</turn>\n" for r, t in [("", ""), ("user", "a"), ("user", "b"), ("user", "z")]
    )
    assert out[None]["loss_spans"] == [(16, 1)]
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_roles_and_texts_of_any_length(spark):
    """Long stretches of what is escaped, which a pattern with nested repeats cannot match."""
    n = 200_000
    long = [":" * n, "\\" * n, "\n" * n, "\\:" * n, "a\\\n:" * n, "### " * (n // 4), "\\" * n + "</turn>"]
    rows = [(k, i, x, y) for k, x in enumerate(long) for i, y in enumerate((x, "t"))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chat_format.format_chats(frame)
    back = chats.select("conv_id", F.inline(chat_format.parse(F.col("formatted"))))
    got = sorted((r[0], r[1], r[2]) for r in back.collect())
    assert got == sorted((k, x, y) for k, _, x, y in rows)


def test_broken_chats_do_not_parse(spark):
    good = "### user: a\n</turn>\n"
    bad = ["", "x", good + "x", good[:-1], "### user a\n</turn>\n", "### user: a### b\n</turn>\n"]
    df = spark.createDataFrame([(b,) for b in [good, *bad]], "s string")
    read = [r[0] for r in df.select(chat_format.parse(F.col("s"))).collect()]
    assert read[0] == [("user", "a")] and read[1] == [] and read[2:] == [None] * 5


# --- quality rules ---------------------------------------------------------------


def repeated_words(words, n=5):
    windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    hits = [i for i, w in enumerate(windows) if windows.count(w) > 1]
    return len({i + j for i in hits for j in range(n)})


def test_measures_equal_a_plain_count(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 25)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "\n x \n x \n\n x"), (203, "#é*| <>\t😀"), (204, "w " * 3000)]
    judged = quality_rules.ledger(spark.createDataFrame(rows, "doc_id long, text string"))
    for row in judged.collect():
        text, m = row["text"] or "", row["ledger"]
        words = text.encode().split()
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert m["n_words"] == len(words)
        assert m["word_chars"] == sum(len(w.decode()) for w in words)
        assert m["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert (m["n_lines"], m["n_dup_lines"]) == (len(lines), len(lines) - len(set(lines)))
        if len(words) < 100:
            assert m["n_repeat_words"] == repeated_words(words)
    assert judged.filter("doc_id = 204").first()["ledger"]["n_repeat_words"] == 3000


def test_policies_and_ablation_agree(spark):
    rows = [(i, "ledger", t) for i, t in enumerate([None, "a b", "w " * 50, "one # two " * 9])]
    df = spark.createDataFrame(rows, "doc_id long, ledger string, text string")
    prose = spark.createDataFrame([(9, "x", " ".join(f"word{i}" for i in range(40)))], df.schema)
    df = df.unionByName(prose)
    judged = quality_rules.ledger(df)
    assert judged.columns == [*df.columns, "ledger_"]
    costs = {r["rule"]: r for r in quality_rules.ablation(judged, "base", "ledger_").collect()}
    assert costs["few_words"]["n_failed"] == 2 and costs["repeated_windows"]["n_failed"] == 2
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns and [r["doc_id"] for r in kept.collect()] == [9]
    assert quality_rules.keep_good(df.limit(0)).count() == 0
