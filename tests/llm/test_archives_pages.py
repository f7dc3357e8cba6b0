"""WARC archives and index, and main-text extraction."""

import base64
import gzip
import hashlib
import html
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import extract, queries, warc
from tidemark.session import work_dir

PAGES = "page_id long, url string, html string, refers_to string, key string, file int"


def _sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def _expected(rows):
    first = {}
    for number, _, body in rows:
        if number is not None:
            first[body or ""] = min(first.get(body or "", number), number)
    out = []
    for number, url, body in rows:
        low = first.get(body or "")
        repeat = low is not None and number != low
        out.append((number, url, len((body or "").encode()), _sha(body), "revisit" if repeat else "response",
                    low if repeat else None))
    return sorted(out, key=str)


def _rows(df):
    return sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(5, "http://B.example.com:80/x?b=2&a=1#f", "same"), (2, "https://www.b.example.com/x?a=1&b=2", "same"),
            (9, None, None), (3, "", ""), (7, "not a url at all", "ä" * 70000), (7, "not a url at all", "ä" * 70000),
            (None, "http://n.example.org/", "null id"), (None, "http://n.example.org/", "same"),
            (11, "http://[bad", "x\r\n\r\ny"), (12, "http://sp.example.org/a b\nc", "WARC/1.1\r\n"), (13, "http://b.example.com/y", None)]
    return rows, spark.createDataFrame([(*r, "t", "k", 1) for r in rows], PAGES)


def test_round_trip_of_odd_pages(spark, odd_pages):
    rows, df = odd_pages
    want = [(n, None if u is None else u.replace("\n", "%0A"), *rest) for n, u, *rest in _expected(rows)]
    assert _rows(warc.archive_and_read(spark, df)) == sorted(want, key=str)


def test_payloads_survive(spark, odd_pages):
    rows, df = odd_pages
    folder = work_dir(spark, "warc-test")
    captures = warc.write_archives(df, folder)
    back = warc.read_records(captures, folder, payload=True).collect()
    by_digest = {_sha(body): (body or "").encode() for _, _, body in rows}
    assert len(back) == len(rows)
    assert all(r.payload is None if r.record_type == "revisit" else bytes(r.payload) == by_digest[r.payload_digest] for r in back)


def test_lookup_across_blocks_and_parts(spark):
    rows = [(k, "http://hot.example.com/" if k % 3 == 0 else f"http://h{k % 7}.example.com/{k}", "p") for k in range(400)]
    df = spark.createDataFrame([(*r, "t", "k", 1) for r in rows], PAGES)
    folder = work_dir(spark, "warc-test")
    captures = warc.write_archives(df, folder)
    directory = warc.build_index(captures, folder, block=10, per_part=60)
    assert directory.select("part").distinct().count() > 3 and directory.count() >= 40
    asked = ["com,example,hot)/", "com,example,h1)/1", "com,example,zzz)/none", None]
    got = warc.lookup(spark.createDataFrame([(k,) for k in asked], "key string"), directory, folder).collect()
    want = {k for k, u, _ in rows if u == "http://hot.example.com/"} | {1}
    assert {r.page_id for r in got} == want and len(got) == len(want)


def test_lookup_of_keys_with_blanks(spark):
    """Blanks sort before ! and $, their escapes after them."""
    names = ["Yahoo", "Yahoo Inc", "Yahoo Mail", "Yahoo!", "Yahoo! Inc", "Yahoo! Mail", "Yahoos", "Yak"]
    names += [f"q{a}{b}{c}" for a in " !$" for b in "a !$" for c in " !$%x"]
    rows = [(k, f"http://b.example.com/wiki/{n}z", f"body {k}") for k, n in enumerate(names)]
    df = spark.createDataFrame([(*r, None, None, 1) for r in rows], PAGES)
    assert _rows(warc.archive_and_read(spark, df)) == _expected(rows)
    folder = work_dir(spark, "warc-test")
    captures = warc.write_archives(df, folder)
    for raw in (captures, captures.withColumn("key", F.replace("key", F.lit("%20"), F.lit(" ")))):
        directory = warc.build_index(raw, folder, block=3, per_part=11)
        got = warc.lookup(raw.select("key"), directory, folder).collect()
        assert sorted((r.key, r.page_id) for r in got) == sorted((warc.url_key(u), k) for k, u, _ in rows)


def test_archive_is_plain_gzip_of_records():
    raw = warc.record_bytes(4, "http://a/", b"body", warc.digest(b"body"), None)
    assert warc.parse_record(gzip.decompress(gzip.compress(raw)))["payload"] == b"body"
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"body", b"tody"))


def test_url_keys():
    assert warc.url_key("https://www.Example.com:443/p?b=1&a=2#x") == "com,example)/p?a=2&b=1"
    assert warc.url_key("http://a.example.com:8080") == "com,example,a:8080)/"
    assert warc.url_key(None) == warc.url_key("") == ""


def test_query_equals_brute_force(spark, sf):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert _rows(queries.QUERIES["op1_warc_index"](spark, sf)) == _expected(rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], PAGES)
    assert warc.archive_and_read(spark, empty).collect() == []
    assert extract.extract(empty).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/a">Menu, one, two</a></li></ul></nav>
<div class="cookie-notice">We use cookies, many, many.</div><!-- <p>hidden comment</p> -->
<article><h1>Title &amp; more</h1><p>First,   para&shy;graph&nbsp;with <b>bold</b>, commas, and text<br>over lines.
<p>Second paragraph &lt;kept&gt;, with an <a href="x">inline link</a> inside.</p><ul><li>Item one<li>Item two</ul>
<div class="ad">Buy, now, cheap, things, today.</div></article>
<aside>Related, stories, here</aside><form><p>Sign up, please</p></form>
<section id="comments"><p>A reader comment, long, with, commas, and more, and more, and more.</p></section>
<footer>&copy; footer, text</footer></body></html>"""


def test_main_text_of_a_page():
    want = ["Title & more", "First, para\xadgraph with bold, commas, and text over lines.",
            "Second paragraph <kept>, with an inline link inside.", "Item one", "Item two"]
    assert extract.main_text(PAGE) == "\n\n".join(want)


def test_scoring_without_article_marks():
    body = "".join(f"<p>Sentence {k}, with commas, and enough words to be read as text by anyone.</p>" for k in range(4))
    links = "".join(f"<li><a href='{k}'>Link {k}, text, text, text, text</a></li>" for k in range(30))
    page = f"<html><body><div><ul>{links}</ul></div><div><div>{body}</div></div></body></html>"
    text = extract.main_text(page)
    assert text.count("Sentence") == 4 and "Link" not in text


ARTICLE = """<html><body><div id="page"><nav>Menu</nav><{0}><h1>Title</h1><p>First paragraph, long enough, with commas,
to be read as the text of this page by anyone.</p>{1}<p>Last paragraph, also long enough, with commas, to be read as text.</p>
</{0}></div><div class="sidebar"><p>Other things, and more, of the site.</p></div></body></html>"""
PROSE = "This is text of the article, and it goes on, with some commas, for a while. " * 4


@pytest.mark.parametrize("tag", ["article", "main", "div"])
@pytest.mark.parametrize("part", [
    '<p title="A hidden gem">KEPT, text.</p>', "<p title='say class=ad here' data-x=\"id='menu'\">KEPT, text.</p>",
    '<section id="discussion"><p>KEPT, text.</p></section>', '<h2 id="legal">KEPT</h2>', '<h2 id="related">KEPT</h2>',
    '<section id="related-work"><h2>Related work</h2><p>KEPT, text.</p></section>', '<p class="notice">KEPT, text.</p>',
    '<section aria-label="Share of renewables"><p>KEPT, text.</p></section>', '<p>A <span class="tags">KEPT</span> word.</p>',
    f'<section class="sponsored"><p>KEPT {PROSE}</p></section>', f'<section id="comments"><p>KEPT {PROSE}</p></section>'])
def test_loose_hints_do_not_drop_article_text(tag, part):
    text = extract.main_text(ARTICLE.format(tag, part))
    assert "KEPT" in text and "First" in text and "Last" in text and "Menu" not in text and "Other" not in text


@pytest.mark.parametrize("tag", ["article", "main", "div"])
@pytest.mark.parametrize("part", [
    '<div class="ad">GONE, now.</div>', '<div class="box ad-banner"><p>GONE, now.</p></div>', "<p hidden>GONE</p>",
    '<p title="x" style="color:red; display: none">GONE</p>', '<div role="navigation">GONE</div>',
    '<div class="share"><a href="a">GONE</a> <a href="b">GONE</a></div>', '<ul id="menu"><li><a href="a">GONE</a></ul>',
    '<section id="comments">' + f'<div class="comment"><p>GONE {PROSE}</p></div>' * 3 + "</section>"])
def test_menus_adverts_and_comments_in_an_article_go(tag, part):
    text = extract.main_text(ARTICLE.format(tag, part))
    assert "GONE" not in text and "First" in text and "Last" in text


def test_parts_between_kept_siblings_stay():
    body = ("<div><h1>Head</h1></div><div><p>First {1}</p><p>Second {1}</p><p>Third {1}</p></div><h2>Sub</h2><div><p>Tiny part</p></div>stray words<ul><li>item one</ul>"
            "<p class='notice'>A notice to readers</p><div><a href='a'>GONE one</a> <a href='b'>GONE two</a></div>"
            "<div class='ad'>GONE</div><div><p>{1}</p></div><blockquote>last words</blockquote><div>GONE</div>")
    text = extract.main_text(f"<html><body>{body.format('', PROSE)}</body></html>")
    prose = PROSE.strip()
    assert text.split("\n\n") == ["Head", f"First {prose}", f"Second {prose}", f"Third {prose}", "Sub", "Tiny part", "stray words", "item one", "A notice to readers",
                                  prose, "last words"]


def test_short_paragraphs_with_other_full_stops():
    body = f"<p>短い段落です。</p><div><p>{PROSE}</p></div><p>本当？</p>"
    text = extract.main_text(f"<html><body><div>{body}</div></body></html>")
    assert text.split("\n\n") == ["短い段落です。", PROSE.strip(), "本当？"]


@pytest.mark.parametrize("part", ["<div><p>word, and more</p>", "<div></b></span>", "<blockquote><li></li>", "<address>x",
                                  "<b><table><tr><td><div></b>x", "<div><main></main>", "<article><header>a</header>",
                                  "<div><article>x", "<p><b>", "<ul><li><div></li>"])
def test_time_grows_with_the_number_of_elements(part):
    start = time.process_time()
    extract.main_text(part * 50_000)
    assert time.process_time() - start < 20  # quadratic work takes minutes


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<script>x", "<!-- never closed", "</p></div>", "<a href='",
                                  "<div>" * 5000, "plain text only", "<p>" + "x" * 200000])
def test_odd_pages_do_not_fail(page):
    text = extract.main_text(page)
    assert text == text.strip()
    assert page != "plain text only" or text == page


def test_extraction_keeps_every_row_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None)],
                               "page_id long, url string, html string, text string")
    rows = extract.extract(df).collect()
    assert len(rows) == 3 and {r.n_chars for r in rows} == {0, len(extract.main_text(PAGE))}


def test_extraction_equals_the_marked_article(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.QUERIES["op9_main_text"](spark, sf).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", p).replace("<br>", " "))).strip()
                 for p in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)
