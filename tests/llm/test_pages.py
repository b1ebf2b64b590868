"""Archives and main text of pages."""

import hashlib
import io
import time

import pytest

from brindle.llm import html_extraction, warc

BIG = "<p>" + "x" * 1200 + "</p>"
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (7, None, BIG), (3, "http://a/ü 3", "small"), (4, "u\r\nWARC-Type: evil", "small"),
    (5, "http://a/5", None), (6, "http://a/6", ""), (None, "http://a/n", BIG), (8, "http://a/8", "é" * 3_000_000), (9, "http://a/9", "a\r\n\r\nb"),
    (7, None, BIG), (10, "http://a/10", "é" * 500), (11, "http://a/11", "é" * 500), (12, "x", "y" * 999), (13, "x", "y" * 999),
]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS html_key", "2 AS digest", "'r' AS refers_to")


def test_archives_round_trip(spark):
    back = warc.read(warc.write(pages(spark, PAGES).repartition(3), file_bytes=5000)).collect()
    assert len(back) == len(PAGES)
    best = {}
    for d, _, h in PAGES:
        best[h or ""] = max(best.get(h or "", -1), -1 if d is None else d)
    for d, url, html in PAGES:
        payload = (html or "").encode()
        copy = len(payload) >= 1000 and d != best[html or ""]
        r = next(r for r in back if r.page_id == d)
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", best[html]) if copy else ("response", None))
        assert r.payload is None if copy else bytes(r.payload) == payload
    assert {r.url for r in back if r.page_id == 3} == {"http://a/ü%203"}
    assert sum(r.page_id == 7 and r.record_type == "response" for r in back) == 2


def test_no_pages(spark):
    assert warc.read(warc.write(pages(spark, []))).count() == 0


def archive(*payloads):
    return b"".join(warc.member(warc.record("response", k, "u", p)) for k, p in enumerate(payloads))


def test_reader_is_sequential_and_strict(monkeypatch):
    good = archive(b"one", b"", b"three" * 100_000)
    for piece in (1, 7, 1 << 16):
        monkeypatch.setattr(warc, "PIECE", piece if piece > 1 else 50)
        assert [r.payload for r in warc.records(io.BytesIO(good))] == [b"one", b"", b"three" * 100_000]
    assert list(warc.records(io.BytesIO(b""))) == []
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good[:-20])))
    record = warc.record("response", 1, "u", b"payload")
    for broken in (record.replace(b"payload", b"Payload"), record.replace(b"Content-Length: 9", b"Content-Length: 8"), record + b"x", b"junk" + record):
        if broken != record:
            with pytest.raises(ValueError):
                list(warc.records(io.BytesIO(warc.member(broken))))


ARTICLE = "This is a sentence of the article that has enough of the words to be taken for text, and it is not short at all. " * 2


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("<html></html>", ""), ("just text of a page", "just text of a page"),
        (f"<nav><a href='/'>Home</a></nav><article><h1>T &amp; t</h1><p>{ARTICLE}<p>Short.</p></article><footer>&copy; x</footer>",
         f"T & t\n{ARTICLE.strip()}\nShort."),
        (f"<title>t</title><style>p{{}}</style><script>if (a < b) '</p>'</script><p>{ARTICLE}</p>", ARTICLE.strip()),
        (f"<body class='with-sidebar'><div class='nav'><article><p>{ARTICLE}</p></article></div><aside><p>{ARTICLE}</p></aside>", ARTICLE.strip()),
        (f"<p>{ARTICLE}</p><section id='comments'><p>{ARTICLE}</p></section><div class='cookie-notice'>We use the cookies of this site.</div>", ARTICLE.strip()),
        (f"<div><p>{ARTICLE}</p></div><form><p>{ARTICLE}</p></form><ul><li><a href=x>{ARTICLE}</a></li></ul>", ARTICLE.strip()),
        ("<article><p>a\n\t b&nbsp;c<br>d</p><!-- <p>no</p> --><p>e &lt;f&gt; &#233; &unknown;</p></article>", "a b c d\ne <f> é &unknown;"),
        ("<article><p>one<p>two<div>three</div></article>", "one\ntwo\nthree"),
        ("<p>open <b>bold <i>both</p><p title='a > b'>next</p>", "open bold both\nnext"),
        ("<article><p>5 < 6 and <3</p></article>", "5 < 6 and <3"),
    ],
)
def test_main_text(html, text):
    assert html_extraction.main_text(html or "") == text


def test_extract(spark):
    rows = [(1, "u", None), (2, None, f"<article><p>{ARTICLE}</p></article>"), (2, None, f"<article><p>{ARTICLE}</p></article>"), (None, "v", "<p>" * 5000 + "é")]
    got = sorted((tuple(r) for r in html_extraction.extract(pages(spark, rows)).collect()), key=str)
    text = ARTICLE.strip()
    assert got == sorted([(1, "u", "", 0), (2, None, text, len(text)), (2, None, text, len(text)), (None, "v", "é", 1)], key=str)
    assert html_extraction.extract(pages(spark, [])).count() == 0


def test_article_of_every_page(spark):
    import re
    from html import unescape

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p)))).strip() for p in re.split(r"</?(?:p|h1)>", body)]
        assert html_extraction.main_text(r.html) == "\n".join(p for p in parts if p)


@pytest.mark.parametrize("depth", [0, 3, 9, 1000])
def test_an_open_paragraph_ends_at_a_block_however_deep(depth):
    assert html_extraction.main_text(f'<p class="ad">x{"<span>" * depth}a<div>{ARTICLE}</div>{ARTICLE}') == f"{ARTICLE.strip()}\n{ARTICLE.strip()}"


@pytest.mark.parametrize(
    "html, text",
    [
        ("AT&<b>amp;</b>T", "AT&amp;T"), ("x &lt<b>;</b> y", "x <; y"), ("a &amp; b &#233;<i>&eacute;</i>", "a & b éé"), ("5 < 6 <b>is</b> so", "5 < 6 is so"),
        ("text <b>of</b> <!-- a comment > that <i>does</i> not end", "text of"), ("text <b>of</b> <a href='x", "text of <a href='x"),
        ("<b title='>'>bold</b> <i title=\"'>\">text</i>", "bold text"), ("one<script>if (a > b) '</b>'</script> two", "one two"),
    ],
)
def test_markup_and_references(html, text):
    assert html_extraction.main_text(html) == text


@pytest.mark.parametrize(
    "html",
    [
        "<a " * 700_000, "<div>" * 100_000 + "</q>" * 250_000, '<a ">"' * 330_000, "<ul>" + "<span>" * 100_000 + "<li></li>" * 150_000,
        "<script>" + "</script " * 200_000, "<p><i>" * 300_000, "<!-- " * 400_000 + ">",
    ],
    ids=["no end of tag", "unmatched end tags", "quotes", "items", "script", "paragraphs", "comments"],
)
def test_long_hostile_pages_take_seconds(html):
    start = time.perf_counter()
    html_extraction.main_text(html)
    assert time.perf_counter() - start < 40
