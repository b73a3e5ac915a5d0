"""Main text against a brute-force reading of the test pages; WARC round trips."""

import gzip
import html
import re
import time
import zlib

import pandas as pd
import pytest
from helpers import SF

from cadence.llm import html_text, warc_build


def test_article_of_the_test_pages(spark):
    pages = pd.read_parquet(f"{SF}/pages.parquet").set_index("page_id")
    got = html_text.extract(spark.read.parquet(f"{SF}/pages.parquet")).toPandas()
    assert len(got) == len(pages)
    for r in got.itertuples():
        body = re.search(r"<article>(.*?)</article>", pages.html[r.page_id], re.S).group(1)
        lines = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1|div)[^>]*>", body)]
        assert r.text == "\n".join(x for x in lines if x) and r.n_chars == len(r.text) and r.url == pages.url[r.page_id]


def test_pages_without_an_article_element():
    long_ = "Several sentences of running text, long enough to be the article of this page. " * 3
    page = (f"<html><head><title>T</title><script>if (a<b) x('</p>')</script></head><body><header><h1>Site</h1></header>"
            f"<ul class='main-menu'><li><a href=/>Home</a><li><a href=/a>A</a></ul><div id=cookie-notice>We use cookies</div>"
            f"<div><h2>Title &amp; more</h2><p>{long_}<p>Short&nbsp;one.<br>next <b>bo</b>ld</div>"
            f"<div class='ad'>Buy</div><div class=comments><p>{long_}</p></div><form><p>Mail</p></form><aside>x</aside>"
            f"<div><a href=/1>one link</a> <a href=/2>two link</a></div><footer>c</footer></body></html>")
    assert html_text.main_text(page) == f"Title & more\n{long_.strip()}\nShort one. next bold"
    for empty in (None, "", "<p></p>", "<script>x</script>", "<!-- a"):
        assert html_text.main_text(empty) == ""
    assert html_text.main_text("<p>a<p>b &lt;i&gt; &amp;amp;") == "a\nb <i> &amp;"
    assert html_text.main_text("<div " * 2000 + "x" + "</div>" * 5) in ("", "x")


def test_end_tags_that_may_be_left_out():
    text = "Running text of the article. "
    for page, want in (
            (f"<html><head><title>T</title><meta charset=utf-8><body><p>{text}</html>", text),
            (f"<head><title>T</title><p>{text}", text), (f"<head><title>T</title>{text}", text),
            (f"<body><article><p class=notice>Note<p>{text}<h2>More</h2></article>", f"{text}\nMore"),
            (f"<div><p class=ad>Buy<div>{text}</div></div>", text),
            (f"<ul><li class=ad>Buy<li>{text}<li>two</ul><p>end", f"{text}\ntwo\nend"),
            (f"<dl><dt class=x>{text}<dd><span class=ad>Buy</span><dd>{text}</dl>", f"{text}\n{text}"),
            (f"<table><tr><td><p class=ad>Buy<td>{text}<tr><td><div class=ad>Buy<tr><td>{text}</table>", f"{text}\n{text}"),
            (f"<ul><li class=menu>m<ul><li>n</ul>o<li>{text}</ul>", text),
            (f"<p>a <svg width=1 /> b<p>{text}<svg><path/></svg>", f"a b\n{text}"), (f"<p>a <math/>{text}", f"a {text}"),
            (f"<div><svg><path d=1><p>{text}</div>", text)):
        assert html_text.main_text(page) == "\n".join(x.strip() for x in want.split("\n")), page


def test_short_parts_beside_long_ones():
    long_, short = "Running text of the article. " * 14, "A closing paragraph after an advert. " * 5
    lines = [long_.strip()] * 3 + [short.strip(), "A heading", "one", "two"]
    tail = f"<p>{short}<div class=ad>Buy</div><h2>A heading</h2><div class=ad>Buy</div><ul><li>one<li>two</ul>"
    for page in (f"<body><div>{f'<p>{long_}' * 3}<div class=ad>Buy</div>{tail}</div></body>",
                 f"<body>{f'<p>{long_}' * 3}<form>Mail</form>{tail}</body>",
                 f"<body><div>{f'<p>{long_}' * 3}</div><aside>x</aside><div>{tail}</div></body>"):
        assert html_text.main_text(page).split("\n") == lines
    # a dropped element that stands between containers still parts them: the second is links only
    assert html_text.main_text(f"<div><p>{long_}</div><div class=ad>Buy</div><div><a href='/1'>first link</a></div>") == long_.strip()
    assert html_text.main_text(f"<div><p>{long_}<div><aside>x</aside></div></div><div><a href='/1'>first link</a></div>") == long_.strip()


def test_article_elements_weigh_but_do_not_decide():
    text, teaser = "Running text of the page, in plain divisions. " * 10, "Teaser of another page. "
    main = f"<div><p>{text}<p>{text}<div class=ad>Buy</div><p>Closing.</div>"
    card = f"<article><h3><a href='/1'>A rather long title of another page</a></h3><p><a href='/1'>{teaser}</a></article>"
    kept = "\n".join([text.strip()] * 2 + ["Closing."])
    assert html_text.main_text(f"<body>{main}{card * 4}</body>") == html_text.main_text(f"<body>{card * 4}{main}</body>") == kept
    plain = f"<article><p>{teaser}</article>"
    assert kept in html_text.main_text(f"<body>{plain * 4}{main}</body>")
    # where the article holds the text, what stands outside is left out, and its links stay
    links = "<aside>x</aside><ul><li><a href='/1'>first source</a><li><a href='/2'>second source</a></ul>"
    page = f"<body><div>Site of the day</div><article><p>{text}<p>{text}{links}</article><div>Made by us</div></body>"
    assert html_text.main_text(page) == "\n".join([text.strip()] * 2 + ["first source", "second source"])
    assert html_text.main_text(f"<body><main><p>{text}</main><div><p>{text}</div></body>") == "\n".join([text.strip()] * 2)


def test_nulls(spark):
    df = spark.createDataFrame([(None, None, None), (1, "u", "<p>x</p>"), (1, "u", "<p>x</p>")], "page_id long, url string, html string")
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in html_text.extract(df).collect()) == [(0, "", 0), (1, "x", 1), (1, "x", 1)]
    assert html_text.extract(df.limit(0)).collect() == []
    assert warc_build.derivatives(warc_build.responses(df)).count() == 6
    assert warc_build.derivatives(warc_build.responses(df.limit(0))).count() == 0


def test_warc_records(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    source = warc_build.responses(pages)
    by_id = {r["record_id"]: r for r in source.collect()}
    made = warc_build.derivatives(source)
    rows = made.collect()
    assert len(rows) == 2 * len(by_id)
    for r in rows:
        parent = by_id[r["refers_to"]]
        assert r["target_uri"] == parent["target_uri"] and r["payload_digest"] == parent["payload_digest"] and r["warc_date"] == parent["warc_date"]
        assert r["content_length"] == len(r["block"]) and r["block_digest"] == warc_build.digest(bytes(r["block"]))
        if r["record_type"] == "metadata":
            assert parent["block_digest"] in bytes(r["block"]).decode() and "source-content-type: text/html" in bytes(r["block"]).decode()
        else:
            assert r["record_type"] == "conversion" and b"<p>" not in bytes(r["block"])
    want = {r["record_id"]: r.asDict() for r in rows}
    members = [bytes(r["warc"]) for r in warc_build.warc_bytes(made).collect()]
    for got in warc_build.parse(b"".join(members)):
        exp = dict(want[got["record_id"]])
        exp.pop("page_id")
        exp["block"], exp["fields"] = bytes(exp["block"]), list(exp["fields"].items())
        assert got == exp
    assert sorted(r["record_id"] for r in made.collect()) == sorted(want)  # the same ids on each run


SENTENCES = "This is a long sentence of the article, which says a lot of things about many topics. " * 3
ARTICLE = f"<p>{SENTENCES}</p><p>{SENTENCES}</p><p>Short end.</p>"
KEPT = [SENTENCES.strip()] * 2 + ["Short end."]
LAYOUTS = {
    "class of the layout": f'<div class="layout with-sidebar">{ARTICLE}<div class="sidebar"><p>Other things here</p></div></div>',
    "class of the post": f'<main class="post comment-open">{ARTICLE}</main>',
    "widgets in widgets": f'<div class="widget"><div class="promo"><article>{ARTICLE}</article></div><div class="related"><p>More of it</p></div></div>',
    "names in camel case": f'<article>{ARTICLE}</article><div class="commentSection"><p>{SENTENCES}</p></div><div id="siteHeader">Slogan</div>',
    "hidden": f'<article>{ARTICLE}</article><div style="color:red; display : none">{SENTENCES}</div><div hidden="">{SENTENCES}</div>',
    "site header": f'<div class="site-header">Name and slogan</div><article>{ARTICLE}</article><ul class="pagination"><li>1</li></ul><div class="copyright">2020</div>',
    "more comments than text": '<div class="sidebar-left"><div class="post">' + ARTICLE + '</div><div class="comments">'
                               + f'<article class="comment"><p>{SENTENCES} {SENTENCES}</p></article>' * 5 + "</div></div>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_marks_weigh_and_do_not_lose_the_page(name):
    assert html_text.main_text(f"<html><body>{LAYOUTS[name]}</body></html>").split("\n") == KEPT


def test_bounded_time():
    start = time.process_time()
    for unit in ("<p><div>", "<svg><p>x", '<div class="widget">text ', '<p class="ad"><li>x'):
        html_text.main_text(unit * 40_000)
    page = "<html><body><div class='widget'>" + ARTICLE * 9_300 + "</div></body></html>"
    assert len(page) > 5_000_000 and html_text.main_text(page).count("\n") == 3 * 9_300 - 1
    assert time.process_time() - start < 30


def test_clashing_columns_and_odd_rows(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "x", 1), (1, None, None, "x", 2), (None, "u", "", "x", 3), (2, "v", "<b", None, None)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == sorted(
        [("1", "\n".join(KEPT), len("\n".join(KEPT))), ("1", "", 0), ("None", "", 0), ("2", "", 0)])


def stored_response(head, body, uri="http://x/"):
    block = f"HTTP/1.1 200 OK\r\n{head}\r\n\r\n".encode() + body
    return warc_build.record("response", "<urn:uuid:1>", None, uri, warc_build.DATE, "application/http; msgtype=response",
                             warc_build.digest(body), block, {"WARC-IP-Address": "0.0.0.0"})


def conversion(head, body):
    return warc_build.derive(stored_response(head, body))[1]["block"].decode()


def test_conversion_reads_charsets_and_codings():
    page = "<p>café au lait</p><p>naïve</p>"
    want = "café au lait\nnaïve"
    latin, utf8 = page.encode("latin-1"), page.encode()
    assert conversion("Content-Type: text/html; charset=iso-8859-1", latin) == want
    assert conversion("content-type: text/html", b'<meta charset="windows-1252">' + latin) == want
    assert conversion("Content-Type: text/html; charset=no-such", utf8) == conversion("X: y", utf8) == want
    chunks = b"".join(b"%x;n=1\r\n%s\r\n" % (len(c), c) for c in (utf8[:9], utf8[9:10], utf8[10:])) + b"0\r\n\r\n"
    assert conversion("Transfer-Encoding: chunked", chunks) == want
    for packed in (gzip.compress(utf8), zlib.compress(utf8)):
        assert conversion("Content-Encoding: " + ("gzip" if packed[:2] == b"\x1f\x8b" else "deflate"), packed) == want
    assert conversion("Content-Encoding: gzip\r\nTransfer-Encoding: chunked", b"zz\r\nno chunk") == "zz\nno chunk"


def test_odd_urls_make_no_headers(spark):
    url = "http://x/a\r\nWARC-Type: forged\r\n\r\nb: c\x00"
    rows = spark.createDataFrame([(1, url, "<p>t</p>", "k", "d")], "page_id long, url string, html string, record_id string, fields string")
    made = warc_build.responses(rows)
    for records in (made, warc_build.derivatives(made)):
        data = b"".join(bytes(r["warc"]) for r in warc_build.warc_bytes(records).collect())
        for r in warc_build.parse(data):
            assert r["target_uri"] == "http://x/a%0D%0AWARC-Type: forged%0D%0A%0D%0Ab: c%00" and r["record_type"] != "forged"
            assert r["block_digest"] == warc_build.digest(r["block"])
    source = made.first()["payload_digest"]
    for r in warc_build.derivatives(made).collect():
        head = gzip.decompress(warc_build.write(r.asDict())).partition(b"\r\n\r\n")[0].decode().split("\r\n")
        assert f"WARC-Payload-Digest: {warc_build.digest(bytes(r['block']))}" in head and f"Source-Payload-Digest: {source}" in head


def test_a_long_body(spark):
    rows = spark.createDataFrame([(1, "u", "<p>" + "some words " * 300_000 + "</p>")], "page_id long, url string, html string")
    got = [r for r in warc_build.derivatives(warc_build.responses(rows)).collect() if r["record_type"] == "conversion"]
    assert len(got) == 1 and got[0]["content_length"] == 11 * 300_000 - 1
