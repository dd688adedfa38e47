"""WARC derivatives: round trip through files, text against an HTML parser, odd messages."""

import base64
import gzip
import hashlib
import time
from html.parser import HTMLParser

import pytest

from staffwise.llm import queries, warc

BLOCKS = {"address", "article", "aside", "blockquote", "body", "br", "caption", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure",
          "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "nav", "ol", "option", "p", "pre", "section",
          "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"}


class Shown(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "head")
        self.out += ["\0"] if tag in BLOCKS else []

    def handle_startendtag(self, tag, attrs):
        self.out += ["\0"] if tag in BLOCKS else []

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "head")
        self.out += ["\0"] if tag in BLOCKS else []

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def parsed(page):
    p = Shown()
    p.feed(page)
    p.close()
    return [x for line in "".join(p.out).split("\0") if (x := " ".join(line.split()))]


def sha1(b):
    return "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_query_text_matches_a_parser_and_links_hold(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op7_warc(spark, sf).collect()
    assert len(rows) == 2 * len(pages) and len({r["record_id"] for r in rows}) == len(rows)
    for r in rows:
        page = pages[r["page_id"]]
        assert r["target_uri"] == page["url"] and r["block_digest"] == sha1(r["block"].encode())
        assert r["source_payload_digest"] == sha1(page["html"].encode())
        if r["warc_type"] == "conversion":
            assert [" ".join(x.split()) for x in r["block"].split("\n")] == parsed(page["html"])
        else:
            assert f"sourceRecordId: {r['refers_to']}\r\n" in r["block"] and "sourceHeader: Content-Type: text/html; charset=utf-8\r\n" in r["block"]
    by = {(r["page_id"], r["warc_type"]): r for r in rows}
    assert all(by[p, "metadata"]["refers_to"] == by[p, "conversion"]["refers_to"] for p in pages)
    assert all(f"conversionRecordId: {by[p, 'conversion']['record_id']}" in by[p, "metadata"]["block"] for p in pages)


ODD = [
    (None, None, None),
    ("", b"", ""),
    ("http://a/\r\nX-Evil: 1", b"HTTP/1.1 200 OK\r\n\r\nplain", "plain"),
    ("u", b"HTTP/1.0 404 Not Found\r\nContent-Type: text/plain\r\nX-A: 1\r\nX-A: 2\r\n folded\r\n\r\na\r\n<b>\r\n\r\nWARC/1.1\r\n\r\n", "a\n<b>\n\nWARC/1.1\n\n"),
    ("u", b"HTTP/1.1 200 OK\nContent-Type: text/html; charset=ISO-8859-1\n\n<p>caf\xe9&amp;&eacute;</p>", "café&é"),
    ("u", b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=no-such\r\n\r\n<meta charset=latin-1><i>\xe9</i>", "é"),
    ("u", b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\n" + gzip.compress(b"<p>zip</p>"), "zip"),
    ("u", b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\nnot zipped", "not zipped"),
    ("u", b"<p title='a>b'>x<br>y</p><!-- <p>no</p> --><script>if (a<b) '</p>'</script>1 < 2 <unclosed", "x\ny\n1 < 2 <unclosed"),
    ("u", b"\xff\xfe broken", "�� broken"),
    ("u", b"<p>" + b"long " * 200_000 + b"</p>", ("long " * 200_000).strip()),
    ("u", b"<a \"" * 20_000, None),
]


def test_odd_messages_and_round_trip(spark, tmp_path):
    rows = [(i % 9 or None, f"<urn:x:{i}>" if i % 2 else None, u, b, "extra") for i, (u, b, _) in enumerate(ODD)] + [(1, "<urn:x:1>", "", b"", "copy")]
    df = spark.createDataFrame(rows, "page_id long, record_id string, target_uri string, block binary, key string")
    made = warc.derivatives(df.selectExpr("*", "'2024-01-01T00:00:00Z' AS warc_date").repartition(3), key="page_id")
    got = made.collect()
    assert len(got) == 2 * len(rows)
    texts = [r["block"] for r in got if r["warc_type"] == "conversion"]
    for _, _, want in ODD:
        assert want is None or want in texts
    assert not any("\n" in r["target_uri"] for r in got)
    warc.write_warc(made, str(tmp_path / "w"), records_per_file=4)
    back = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert sorted((dict(r["fields"])["WARC-Record-ID"], bytes(r["block"]).decode()) for r in back) == sorted((r["record_id"], r["block"]) for r in got)
    for r in back:
        f = dict(r["fields"])
        assert f["WARC-Block-Digest"] == sha1(bytes(r["block"])) and f["WARC-Refers-To"] and f["WARC-Type"] in ("metadata", "conversion")


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>A</title><body><p>all of the text</p></body></html>", "all of the text"),
    ("<html><head><meta charset=utf-8><title>A</title><!-- <p>no --><style>p {}</style><p>all</p><p>text</p>", "all\ntext"),
    ("<head><title>A</title></head><p>x</p>", "x"),
    ("<head>words", "words"),
    ("<head><title>no end<p>x</p>", "no end\nx"),
    ("<head-x>a</head-x><p>b</p>", "a\nb"),
    ("<p>a</p><svg width='1>2' class=\"x\"/><p>b</p>", "a\nb"),
    ("<p>a</p><svg><text>no</text></svg><p>b</p>", "a\nb"),
    ("<p>a</p><svg><p>b</p>", "a\nb"),
    ("<p>a</p><noscript><p>b</p>", "a\nb"),
    ("<p>a</p><template><p>b</p>", "a\nb"),
    ("<svg/>" * 50_000 + "<noscript>" * 50_000 + "<head>" * 50_000 + "b", "b"),
    ("<p>a</p><script>b", "a"),
    ("<p>a</p><style>b", "a"),
    ("<p>a</p><!-- b", "a"),
])
def test_elements_without_an_end_tag(page, want):
    assert warc.page_text(page) == want


def test_chunks_types_and_titles():
    def both(head, body):
        rows = {r[0]: r for r in warc.derived("<urn:x>", "u", "d", b"HTTP/1.1 200 OK\r\n" + head + b"\r\n\r\n" + body)}
        return rows["metadata"][-1], rows["conversion"][-1] if "conversion" in rows else None

    page = b"<title>T</title><p>hello there, you</p>"
    chunks = b"".join(b"%x;x=1\r\n%s\r\n" % (len(c), c) for c in (page[:9], page[9:])) + b"0\r\nTrailer: x\r\n\r\n"
    meta, text = both(b"Transfer-Encoding: chunked", chunks)
    assert text == "T\nhello there, you" and "title: T\r\n" in meta and f"sourcePayloadDigest: {sha1(chunks)}\r\n" in meta
    z = gzip.compress(page)
    assert both(b"Transfer-Encoding: chunked\r\nContent-Encoding: gzip", b"%X\n%s\n0\n\n" % (len(z), z))[1] == "T\nhello there, you"
    assert both(b"Transfer-Encoding: chunked", b"<p>not chunked</p>")[1] == "not chunked"
    assert both(b"Transfer-Encoding: chunked", b"5\r\nhello")[1] == "hello"
    for head, why in ((b"Content-Type: image/png", "content-type image/png"), (b"Content-Encoding: br", "content-encoding br")):
        meta, text = both(head, b"\x89PNG\x00\xff")
        assert text is None and f"conversionSkipped: {why}\r\n" in meta and "conversionRecordId" not in meta
    assert both(b"Content-Type: application/json", b'{"a": "<b>"}')[1] == '{"a": "<b>"}'
    assert both(b"Content-Type: application/xhtml+xml", b"<p>x</p>")[1] == "x"


@pytest.mark.parametrize("page, want", [
    ("<!-- <title>no</title> --><title>yes &amp; so</title>", "yes & so"),
    ("<head><svg><title>no</title></svg><script>'<title>no</title>'</script><title\n>yes</title></head>", "yes"),
    ("<svg><title>no</title></svg>", ""), ("<title>never ends", ""), ("<titles>no</titles>", ""), ("", ""),
    ("<title>" * 100_000, ""), ("<title " * 100_000, ""), ("<title>x</title>" + "<title>" * 100_000, "x"),
])
def test_titles_in_linear_time(page, want):
    start = time.process_time()
    assert warc.page_title(page) == want
    assert time.process_time() - start < 5


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.derivatives(warc.responses(pages), key="page_id").count() == 0


@pytest.mark.parametrize("members", [1, 3])
def test_unpacked(members):
    assert warc.unpacked(b"".join(gzip.compress(b"ab") for _ in range(members))) == b"ab" * members
    assert warc.unpacked(b"plain") == b"plain" and warc.unpacked(b"") == b""


def test_body_of_several_gzip_members():
    two = gzip.compress(b"one ") + gzip.compress(b"two")
    assert warc.decoded(two, "gzip") == b"one two"
    assert warc.decoded(two + b"\x1f\x8bbroken", "gzip") == b"one two"
    assert warc.decoded(b"not zipped", "gzip") == b"not zipped" and warc.decoded(b"", "gzip") == b""
