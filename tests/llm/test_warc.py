"""WARC derivatives: text against an independent parser, and a round trip through files."""

import gzip
import glob
import re
import time
from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm import warc
from conftest import scratch

BLOCKS = set(("address article aside blockquote body br dd div dl dt footer form h1 h2 h3 h4 h5 h6 head header hr html li main "
              "nav ol option p pre section table td th title tr ul").split())


class Plain(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "noscript", "template")
        if tag in BLOCKS:
            self.out.append("\0")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "noscript", "template")
        if tag in BLOCKS:
            self.out.append("\0")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def plain_text(page):
    p = Plain()
    p.feed(page)
    p.close()
    lines = [" ".join(x.split()) for x in "".join(p.out).split("\0")]
    return "\n".join(x for x in lines if x)


def test_text_of_real_pages(spark, sf_small):
    for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect():
        assert warc.visible_text(r.html) == plain_text(r.html)


def test_broken_markup():
    assert warc.visible_text("a<!-- open <p>b") == "a"
    assert warc.visible_text("a<script>x") == "a"
    assert warc.visible_text("a <b class='x'>b</b>c &lt;p&gt; &eacute;&#233; 1 < 2<br>d<p") == "a bc <p> éé 1 < 2\nd"
    assert warc.visible_text("") == ""


def test_open_tags_take_linear_time():
    for tag in ("<a ", "<title ", "<!", "<!-- ", "<script ", "<p ", "<a href=", "<a href='", '<a href="x ', "</title", "<", "&amp"):
        page = tag * (1_000_000 // len(tag))
        start = time.process_time()
        warc.derive("<id>", "u", "d", None, None, b"HTTP/1.1 200 OK\r\n\r\n" + page.encode())
        assert time.process_time() - start < 3, tag


LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["<a ", "<A\n", "<ab", "href=", "href = ", "'", '"', "x", "y>", ">", " ", "<title>", "<title a", "</title>", "</a>", "<b "]), max_size=14))
def test_links_and_title_by_one_pattern(pieces):
    page = "".join(pieces)
    want = [next(filter(None, m.groups()), "") for m in LINK.finditer(page)]
    if not re.search(r"href\s*=\s*(?:>|$)", page):  # a value that is missing ends a tag's links
        assert list(warc.links_of(page)) == want
    title = TITLE.search(page)
    assert warc.title_of(page) == (title[1] if title else "")


def test_charset_of_the_response():
    def text(header, raw):
        return warc.derive("<id>", "u", "d", None, None, f"HTTP/1.1 200 OK\r\n{header}\r\n\r\n".encode() + raw)[1][2]

    assert text("Content-Type: text/html; charset=ISO-8859-1", "<p>é".encode("latin-1")) == "é"
    assert text('content-type: text/html; Charset="shift_jis"', "<p>漢字".encode("shift_jis")) == "漢字"
    assert text("Content-Type: text/html; charset=nonsense", "<p>é".encode()) == "é" == text("X: charset=latin-1", "<p>é".encode())


ROWS = [(1, "http://a/x", "<title>T &amp; U</title><p>One\r\n two<a href='/l'>l</a><p>WARC/1.0\r\n\r\nx", "v"),
        (2, "http://a/y\r\nz", None, "v"), (3, None, "", "v"), (None, "http://a/é", "é", "v"),
        (4, "http://b", "long " * 50000, "v"), (4, "http://b", "long " * 50000, "v")]


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string, block string")
    responses = warc.responses_of_pages(df)
    path = f"{scratch(spark, 'warc-')}/out"
    warc.write_warc(warc.derivatives(responses), path)
    got = warc.read_warc(spark, path).collect()
    assert len(got) == 2 * len(ROWS)
    source = {r.record_id: r for r in responses.collect()}
    made = {}
    for r in got:
        h, raw = r.headers, r.block.encode()
        assert int(h["Content-Length"]) == len(raw) and h["WARC-Block-Digest"] == warc.sha1(raw)
        assert h["WARC-Refers-To"] in source and h["WARC-Date"] == warc.CRAWL_DATE
        assert h.get("WARC-Target-URI") == source[h["WARC-Refers-To"]].target_uri
        made.setdefault(h["WARC-Refers-To"], {})[h["WARC-Type"]] = r
    for key, pair in made.items():
        meta, text = pair["metadata"], pair["conversion"]
        payload = bytes(source[key].block).partition(b"\r\n\r\n")[2]
        assert meta.headers["WARC-Concurrent-To"] == text.headers["WARC-Record-ID"]
        assert text.headers["WARC-Source-Payload-Digest"] == warc.sha1(payload)
        assert f"source-payload-digest: {warc.sha1(payload)}" in meta.block
        assert f"source-block-digest: {warc.sha1(bytes(source[key].block))}" in meta.block
        assert text.block == warc.visible_text(payload.decode())
        assert "http-status: HTTP/1.1 200 OK" in meta.block and "http-header: Content-Type: text/html" in meta.block
    first = next(p for p in made.values() if "title: T & U" in p["metadata"].block)
    assert "outlink: /l" in first["metadata"].block and first["conversion"].block == "T & U\nOne twol\nWARC/1.0 x"


def test_files_are_plain_warc(spark):
    """Read by lengths alone, as any WARC reader does."""
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string, block string")
    path = f"{scratch(spark, 'warc-')}/out"
    warc.write_warc(warc.derivatives(warc.responses_of_pages(df)), path)
    n = 0
    for f in glob.glob(f"{path}/part-*"):
        data = gzip.open(f).read()
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.0\r\n")
            size = int(re.search(rb"Content-Length: (\d+)", head)[1])
            assert data[size:size + 4] == b"\r\n\r\n"
            data = data[size + 4:]
            n += 1
    assert n == 2 * len(ROWS)


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.derivatives(warc.responses_of_pages(df)).count() == 0
