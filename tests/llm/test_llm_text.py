"""Main text, byte-level BPE and WARC derivatives against brute force and round trips."""

import base64
import hashlib
from html.parser import HTMLParser

import public_tokenizers
import pytest
import tiktoken

from spanledger.llm import byte_bpe, main_text, queries, warc

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SENTENCE = "This is the text of the article, and it is long enough for the rules to take it as a part of what was written here. "

PAGES = {
    "plain": ("<html><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One  two.<p>Three<br>four</article><footer>x</footer>", "A & B\nOne two.\nThree four"),
    "marks": (
        f"<main><header><h1>Title</h1></header><p>{SENTENCE}</p><div class='cookie-notice'>We use the cookies of the site.</div>"
        f"<aside><p>{SENTENCE}</p></aside><form><p>{SENTENCE}</p></form><section id=comments><p>{SENTENCE}</p></section><p>End.</p></main>",
        f"Title\n{SENTENCE.strip()}\nEnd.",
    ),
    "no container": (
        f"<div class=menu><a href=1>One</a> <a href=2>Two</a></div><h2>Head</h2><p>{SENTENCE * 2}</p><p>Short.</p><p>{SENTENCE * 3}</p>"
        "<div class='sidebar'>Side</div><script>var x = '<p>no</p>';</script>",
        f"Head\n{(SENTENCE * 2).strip()}\nShort.\n{(SENTENCE * 3).strip()}",
    ),
    "junk without container": ("<nav><a href=1>x</a></nav><h1>Te Te</h1><p>" + "Te " * 40 + "</p><p>a | b</p><footer>f</footer>", "Te Te\n" + ("Te " * 40).strip() + "\na | b"),
    "closing line": (f"<p>{SENTENCE * 2}</p><p>© 2024 example. All rights reserved.</p>", (SENTENCE * 2).strip()),
    "table layout": (f"<table><tr><td><a href=1>One</a><td><p>{SENTENCE * 2}<p>{SENTENCE * 2}</table>", "\n".join([(SENTENCE * 2).strip()] * 2)),
    "comments": (f"<div id=content><p>{SENTENCE}</p><div class='comment-list'><article class=comment><p>{SENTENCE}</p></article></div></div>", SENTENCE.strip()),
    "symbols": ("<article><p>Oi### tre%%% &lt;b&gt;</p><p>&eacute;&#233;&nbsp;x</p></article>", "Oi### tre%%% <b>\néé x"),
    "broken": ("<article><p><b>First.<br><p>Second <a href='x'>y</a> and <i>more<p>Third</article", "First.\nSecond y and more\nThird</article"),
    "ad before": ("<div class=ad>Buy the best of it.</div><article><p>Text.</p></article>", "Text."),
    "empty": ("", ""),
    "only script": ("<script>var a = 1;</script><style>p{}</style>", ""),
}


@pytest.mark.parametrize("name", [n for n in PAGES if n != "broken"])
def test_main_text(name):
    html, text = PAGES[name]
    assert main_text.main_text(html) == text


def test_unclosed_markup_keeps_all_text():
    got = main_text.main_text(PAGES["broken"][0]).split("\n")
    assert got[:2] == ["First.", "Second y and more"] and got[2].startswith("Third")


def test_extract_rows(spark):
    rows = [(1, None, None), (1, "u", "<article><p>a</p></article>"), (1, "u", "<article><p>a</p></article>"), (None, "v", "<p>" + "x" * 100_000)]
    got = main_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert [(r.page_id, r.text[:3], r.n_chars) for r in got[:3]] == [(1, "", 0), (1, "a", 1), (1, "a", 1)]
    assert len(got) == 4
    assert main_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


TEXTS = [
    None, "", " ", "\n\n", "a", "It's  the\tend.\n\n  New line 　 x", "é" * 300 + "  b", "哈哈哈 一二三　四", "🙂🙂‍🙂 ok", "aaaa" * 500,
    "x\x1cy \x1f z\u0085 w", "  lead and trail  ", "don't we'll 12345 67", "\r\n\r\n a\r\nb", "ﬁ ﷺ \U0001F468‍\U0001F469", "haha" * 50 + "!!!" * 40,
]


@pytest.fixture(scope="module")
def exact():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_rank_library(spark, exact):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] * 2, "doc_id bigint, text string")
    for r in byte_bpe.digests(df, RANKS, public_tokenizers.PATTERN).collect():
        text = TEXTS[r.doc_id] or ""
        ids = exact.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_round_trip_and_offsets(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    coded = byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    for r in coded.collect():
        text = TEXTS[r.doc_id] or ""
        ends = [0, *r.end]
        assert all(0 <= a < b <= len(text) for a, b in zip(r.first, r.end, strict=True))
        # Tokens follow each other; one that begins inside a character shares that character.
        assert all(a in (e, e - 1) for a, e in zip(r.first, ends, strict=False)) and ends[-1] == len(text)
    back = {r.doc_id: r.text for r in byte_bpe.decode(coded, RANKS, public_tokenizers.PATTERN).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}


def test_split_characters_and_missing_ids(spark, exact):
    part = exact.encode_ordinary("𝔘")[:1]
    rows = spark.createDataFrame([(1, part), (2, None), (3, [])], "doc_id bigint, ids array<int>")
    got = {r.doc_id: r.text for r in byte_bpe.decode(rows, RANKS, public_tokenizers.PATTERN).collect()}
    assert "�" in got[1] and got[2] == got[3] == ""
    assert byte_bpe.digests(spark.createDataFrame([], "doc_id bigint, text string"), RANKS, public_tokenizers.PATTERN).count() == 0


def test_stretches_of_long_texts(exact):
    import pyarrow as pa

    text = ("Ein Satz. " * 3000 + "\n") * 3
    ids, bounds = byte_bpe.encode_column(pa.array([text, None, "x"]), RANKS, public_tokenizers.PATTERN)
    assert ids[bounds[0] : bounds[1]].tolist() == exact.encode_ordinary(text) and bounds.tolist()[1:] == [bounds[1], bounds[1], bounds[1] + 1]


def test_warc_records():
    html = "<html lang=de><head><title>T &amp; t</title></head><body><p>Ä</p><p>x <a href='/a?b=1&amp;c'>l</a></p></body></html>"
    meta, text = warc.derive(7, None, "http://h/x", None, "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-Own: 1", html)
    assert meta["concurrent_to"] == text["record_id"] and text["concurrent_to"] == meta["record_id"]
    assert meta["refers_to"] == text["refers_to"] and meta["source_digest"] == text["source_digest"]
    assert text["source_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
    for r in (meta, text):
        head, block = r["record"].split("\r\n\r\n", 1)
        headers = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
        assert head.startswith("WARC/1.1\r\n") and headers["WARC-Refers-To"] == r["refers_to"]
        assert int(headers["Content-Length"]) == len(block.encode()) == r["content_length"]
        assert headers["WARC-Block-Digest"] == warc.labelled_digest(block.encode()) == r["block_digest"]
    assert text["record"].endswith("\r\n\r\nÄ\nx l")
    assert "source-X-Own: 1\r\n" in meta["record"] and "outlink: /a?b=1&c\r\n" in meta["record"] and "title: T & t\r\n" in meta["record"]
    assert warc.derive(7, None, "http://h/x", None, "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-Own: 1", html) == [meta, text]


@pytest.mark.parametrize("end", ["\r\n", "\n", "\r"])
def test_warc_headers_with_any_line_ends(end):
    http = end.join(["HTTP/1.1 200 OK", "X-One : 1", "X-Two: a", "  b", "", "no field"])
    meta, _ = warc.derive(1, None, "http://h/\nx", None, http, "<p>a</p>")
    fields = meta["record"].split("\r\n\r\n", 1)[1].split("\r\n")
    assert fields == ["source-X-One: 1", "source-X-Two: a b", ""] and "WARC-Target-URI: http://h/ x\r\n" in meta["record"]
    assert meta["source_headers"] == "HTTP/1.1 200 OK; X-One : 1; X-Two: a b; no field"


class Page(HTMLParser):
    """Words that a reader sees, and links, by another parser."""

    def __init__(self):
        super().__init__()
        self.words, self.links, self.hidden = [], 0, []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "noscript", "template", "head"):
            self.hidden.append(tag)
        self.links += tag == "a" and bool(dict(attrs).get("href"))

    def handle_endtag(self, tag):
        if self.hidden and tag == self.hidden[-1]:
            self.hidden.pop()

    def handle_data(self, data):
        if not self.hidden:
            self.words.append(data)


def test_warc_query_against_another_parser(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    whole = warc.derivatives(warc.responses_of(spark.read.parquet(f"{sf}/pages.parquet"))).collect()
    assert len(whole) == 2 * len(pages) and len({r.record_id for r in whole}) == len(whole)
    by_page = {(r.key, r.record_type): r for r in whole}
    for i, page in pages.items():
        meta, text = by_page[i, "metadata"], by_page[i, "conversion"]
        body = (page.html or "").encode()
        parsed = Page()
        parsed.feed(page.html or "")
        block = text.record.split("\r\n\r\n", 1)[1]
        assert "".join("".join(parsed.words).split()) == "".join(block.split()) and text.text_chars == len(block)
        assert meta.n_links == parsed.links == meta.record.count("\r\noutlink: ")
        for r, other in ((meta, text), (text, meta)):
            data = r.record.split("\r\n\r\n", 1)[1].encode()
            assert r.source_digest == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
            assert r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
            assert r.content_length == len(data) and r.record_sha256 == hashlib.sha256(r.record.encode()).hexdigest()
            assert r.concurrent_to == other.record_id and r.refers_to == other.refers_to and r.url == page.url
    found = {(r.page_id, r.record_type): r.record_sha256 for r in queries.op10_warc_derivatives(spark, sf).collect()}
    assert found == {k: r.record_sha256 for k, r in by_page.items()}


def test_warc_rows_and_files(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a", "<p>a</p>"), (1, "http://a", "<p>a</p>"), (None, None, None)], "page_id bigint, url string, html string"
    )
    records = warc.derivatives(warc.responses_of(pages))
    rows = records.collect()
    assert len(rows) == 6 and {r.record_type for r in rows} == {"metadata", "conversion"}
    assert [r.text_chars for r in rows if r.key is None] == [0, 0]
    warc.write(records, str(tmp_path / "w"))
    data = b"".join(p.read_bytes() for p in (tmp_path / "w").glob("part-*"))
    for _ in range(6):  # each record's length leads to the next
        head, rest = data.split(b"\r\n\r\n", 1)
        size = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert head.startswith(b"WARC/1.1") and rest[size : size + 4] == b"\r\n\r\n"
        data = rest[size + 4 :]
    assert data == b""
