"""WARC derivatives: metadata and plain-text records of captured responses.

Every response record gives two records that refer to it:

* ``metadata`` (``application/warc-fields``): the source's status, headers and
  digests, the charset the body was read in, and its title;
* ``conversion`` (``text/plain``): the body's text.

Record ids are name-based on the source's id, so a task that runs again makes
the same records.  ``write_warc`` and ``read_warc`` keep records in files.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, fresh, quoted

VERSION = "WARC/1.1"
FIELDS = ["warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "block_digest", "source_payload_digest", "block"]

HIDDEN = re.compile(r"""<!--|<(script|style|template|noscript|svg|head)(?=[\s/>])(?:(?>[^<>"']+|"[^"]*"|'[^']*')*+>|[^>]*>)""", re.I)
CLOSE = {n: re.compile(rf"</{n}(?=[\s/>])[^>]*>", re.I) for n in ("script", "style", "template", "noscript", "svg", "title", "noframes", "head")}
IN_HEAD = re.compile(r"\s+|(?=<!--)|</?(?:meta|link|base|basefont|bgsound)(?=[\s/>])[^>]*>|<(title|script|style|template|noscript|noframes)(?=[\s/>])[^>]*>", re.I)
TITLE = re.compile(r"<title(?=[\s/>])[^<>]*>", re.I)
TEXTUAL = re.compile(r"\s*(?:text/|application/(?:[\w.-]+\+)?(?:xml|json|javascript|ecmascript)\b|[\w.-]+/[\w.-]+\+(?:xml|json)\b)", re.I)
TAG = re.compile(r"""<[a-z/!?](?>[^<>"']+|"[^"]*"|'[^']*')*+>""", re.I)
BREAK = re.compile(r"""</?(?:address|article|aside|blockquote|body|br|caption|dd|details|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr
    |html|legend|li|main|nav|ol|option|p|pre|section|select|summary|table|tbody|td|tfoot|th|thead|title|tr|ul)(?=[\s/>])(?>[^<>"']+|"[^"]*"|'[^']*')*+>""", re.I | re.X)
BLANKS = re.compile(r"[ \t\r\f\v\xa0]+")
CHARSET = re.compile(rb"""<meta[^>]{0,300}charset\s*=\s*["']?\s*([\w.:-]+)""", re.I)


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(kind: str, source: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}:{source}')}>"


def field(value: str) -> str:
    """A header value: control characters percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def http_message(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, header fields and body; a block without an HTTP status
    line is all body."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    end = re.search(rb"\r?\n\r?\n", block)
    head, body = (block[: end.start()], block[end.end():]) if end else (block, b"")
    lines = re.sub(r"\r?\n[ \t]+", " ", head.decode("utf-8", "replace")).splitlines()
    fields = [(n.strip(), v.strip()) for n, _, v in (x.partition(":") for x in lines[1:]) if n.strip()]
    return lines[0], fields, body


def decoded(body: bytes, encoding: str) -> bytes:
    """The body without gzip or deflate; as it is where it can't be undone."""
    if encoding.lower() not in ("gzip", "x-gzip", "deflate"):
        return body
    out, rest = [], body
    try:
        while not out or rest[:2] == b"\x1f\x8b":  # one gzip member or many
            z = zlib.decompressobj(zlib.MAX_WBITS | 32)
            out.append(z.decompress(rest))
            rest = z.unused_data
    except zlib.error:  # members before a broken one stay
        return b"".join(out) or body
    return b"".join(out)


def unchunked(body: bytes) -> bytes:
    """The body without the sizes of chunked transfer; as it is where it isn't
    chunked.  What stands before a broken chunk stays."""
    out, at = [], 0
    while True:
        end = body.find(b"\n", at, at + 1024)
        size = re.fullmatch(rb"\s*([0-9a-fA-F]{1,12})\s*(?:;.*)?\s*", body[at:end]) if end >= 0 else None
        if not size:
            return b"".join(out) or body
        n = int(size[1], 16)
        if not n:
            return b"".join(out)
        out.append(body[end + 1:end + 1 + n])
        at = end + 1 + n
        at += 2 if body[at:at + 2] == b"\r\n" else body[at:at + 1] == b"\n"


def body_text(body: bytes, content_type: str) -> tuple[str, str]:
    """The body as text and the charset it was read in: that of the header,
    else of a meta element near the start, else UTF-8."""
    named = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", content_type, re.I)
    found = CHARSET.search(body[:4096])
    for name in (named and named[1], found and found[1].decode("ascii", "replace")):
        if name:
            try:
                return body.decode(name, "replace"), name.lower()
            except (LookupError, ValueError):  # an unknown name
                continue
    return body.decode("utf-8", "replace"), "utf-8"


def without_hidden(page: str, head: bool = False) -> str:
    """The page with a blank for what isn't shown (but the head's other parts with ``head``).  Comments, scripts and styles
    without an end run to the end of the page.  A head ends at its end tag or
    before the first thing that can't stand in one; of other elements without an
    end tag, and of a self-closing svg, only the tag goes."""
    closed: dict[str, re.Match | None] = {}

    def after(name: str, at: int) -> int | None:  # each end tag is looked for once, however often its element opens
        m = closed.get(name)
        if name not in closed or m and m.start() < at:
            m = closed[name] = CLOSE[name].search(page, at)
        return m.end() if m else len(page) if name in ("script", "style") else None

    def comment(at: int) -> int:
        end = page.find("-->", at + 4)
        return len(page) if end < 0 else end + 3

    out, at = [], 0
    while m := HIDDEN.search(page, at):
        out += [page[at : m.start()], " "]
        name, at = (m[1] or "").lower(), m.end()
        if not name:
            at = comment(m.start())
        elif name == "head" and head:
            pass
        elif name == "head":
            while part := IN_HEAD.match(page, at):
                end = after(part[1].lower(), part.end()) if part[1] else comment(at) if not part[0] else part.end()
                if end is None:
                    break
                at = end
            if end := CLOSE["head"].match(page, at):
                at = end.end()
        elif not (name == "svg" and m[0].endswith("/>")):
            at = after(name, at) or at
    return "".join([*out, page[at:]])


def page_text(page: str) -> str:
    """What a page shows, one line per block element, blank lines dropped."""
    shown = TAG.sub("", BREAK.sub("\n", BLANKS.sub(" ", without_hidden(page).replace("\n", " "))))
    shown = html.unescape(shown) if "&" in shown else shown
    return "\n".join(x for line in shown.split("\n") if (x := BLANKS.sub(" ", line).strip()))


def page_title(page: str) -> str:
    """The first title that is not hidden, one without an end being none."""
    shown = without_hidden(page, head=True)
    start = TITLE.search(shown)
    end = CLOSE["title"].search(shown, start.end()) if start else None
    return page_text(shown[start.end():end.start()]) if end else ""


def derived(source: str, uri: str, date: str, block: bytes) -> list[tuple[str, ...]]:
    """The metadata and the conversion record of one response, as ``FIELDS``;
    only the former for a body that is no text (by its type) or whose encoding
    can't be undone, with the reason as ``conversionSkipped``."""
    status, fields, stored = http_message(block)
    first = {}
    for n, v in fields:
        first.setdefault(n.lower(), v)
    body = unchunked(stored) if first.get("transfer-encoding", "").lower().endswith("chunked") else stored
    kind, coding = first.get("content-type", ""), first.get("content-encoding", "").strip().lower()
    digest = sha1(stored)
    skipped = (f"content-encoding {coding}" if coding not in ("", "identity", "gzip", "x-gzip", "deflate")
               else f"content-type {kind}" if kind.strip() and not TEXTUAL.match(kind) else "")
    if skipped:
        info = [("sourceRecordId", source), ("sourceBlockDigest", sha1(block)), ("sourcePayloadDigest", digest), ("httpStatus", status),
                *[("sourceHeader", f"{n}: {v}") for n, v in fields], ("conversionSkipped", skipped)]
        meta = "".join(f"{n}: {field(v)}\r\n" for n, v in info)
        return [("metadata", record_id("metadata", source), source, uri, date, "application/warc-fields", sha1(meta.encode()), digest, meta)]
    page, charset = body_text(decoded(body, coding), kind)
    plain = bool(kind.strip()) and not re.match(r"\s*(?:text/html|application/(?:[\w.-]+\+)?xml)", kind, re.I)
    text = page.replace("\r\n", "\n") if plain else page_text(page)
    info = [("sourceRecordId", source), ("sourceBlockDigest", sha1(block)), ("sourcePayloadDigest", digest), ("httpStatus", status),
            *[("sourceHeader", f"{n}: {v}") for n, v in fields], ("charset", charset), ("title", "" if plain else page_title(page)),
            ("conversionRecordId", record_id("conversion", source))]
    meta = "".join(f"{n}: {field(v)}\r\n" for n, v in info)
    return [(k, record_id(k, source), source, uri, date, t, sha1(b.encode()), digest, b)
            for k, t, b in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", text))]


def derivatives(df: DataFrame, key: str, record: str = "record_id", uri: str = "target_uri", date: str = "warc_date", block: str = "block") -> DataFrame:
    """Two rows for each response in ``df``, one where its body is no text (see
    :func:`derived`): ``key`` and the columns ``FIELDS``.

    A null record id is replaced by one made from the uri and the block's
    digest; a null uri or date becomes empty, a null block an empty one.
    Repeated responses give repeated records.
    """
    (inner,) = fresh(df, "key")
    text = lambda c: F.coalesce(col(c).cast("string"), F.lit(""))
    src = df.select(col(key).alias(inner), col(record).cast("string"), text(uri), text(date), F.coalesce(col(block).cast("binary"), F.lit(b"")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 500):  # so that the texts of few pages are held at once
                some = b.slice(s, 500)
                at, rows = [], []
                for i, (r, u, d, x) in enumerate(zip(*some.columns[1:], strict=True)):
                    u, d, x = field(u.as_py()), d.as_py(), x.as_py()
                    made = derived(r.as_py() or record_id("response", u + sha1(x)), u, d, x)
                    rows += made
                    at += [i] * len(made)
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, pa.string()) for c in zip(*rows)]],
                                                 names=[key, *FIELDS])

    return src.mapInArrow(run, f"{quoted(key)} {src.schema[0].dataType.simpleString()}, " + ", ".join(f"{f} string" for f in FIELDS))


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Raw pages as response records: ``key``, ``record_id``, ``target_uri``,
    ``warc_date`` and the HTTP message ``block``."""
    body = F.coalesce(F.encode(col(page), "utf-8"), F.lit(b""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body), F.lit("\r\n\r\n"))
    hexed = F.md5(F.concat_ws("\n", F.lit("response"), col(key).cast("string"), col(url)).cast("binary"))
    parts = [F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select(col(key), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
                        col(url).alias("target_uri"), F.lit(date).alias("warc_date"), F.concat(F.encode(head, "utf-8"), body).alias("block"))


def record_text() -> Column:
    """A whole record from the columns ``FIELDS``, without the line ends that close it."""
    head = [(F.lit("WARC-Type"), "warc_type"), (F.lit("WARC-Record-ID"), "record_id"), (F.lit("WARC-Refers-To"), "refers_to"),
            (F.lit("WARC-Target-URI"), "target_uri"), (F.lit("WARC-Date"), "warc_date"), (F.lit("Content-Type"), "content_type"),
            (F.lit("WARC-Block-Digest"), "block_digest"), (F.lit("WARC-Source-Payload-Digest"), "source_payload_digest")]
    lines = [F.when(F.col(c) != "", F.concat(n, F.lit(": "), F.col(c))) for n, c in head]
    return F.concat(F.concat_ws("\r\n", F.lit(VERSION), *lines, F.concat(F.lit("Content-Length: "), F.octet_length("block"))), F.lit("\r\n\r\n"), F.col("block"))


def write_warc(records: DataFrame, path: str, records_per_file: int = 20_000) -> None:
    """Write records (columns ``FIELDS``) as gzipped WARC files.  A record's
    closing line ends are the writer's line separator."""
    (records.select(record_text().alias("value")).write.mode("error").option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse_records(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(header fields, block) of each record of an unpacked file."""
    at = 0
    while (start := data.find(b"WARC/", at)) >= 0:
        end = data.index(b"\r\n\r\n", start)
        fields = [(n.strip(), v.strip()) for n, _, v in (x.partition(":") for x in data[start:end].decode("utf-8", "replace").split("\r\n")[1:])]
        size = int(next(v for n, v in fields if n.lower() == "content-length"))
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 4 + size


def unpacked(data: bytes) -> bytes:
    """A file's bytes without gzip, one member or many."""
    out = []
    while data[:2] == b"\x1f\x8b":
        z = zlib.decompressobj(zlib.MAX_WBITS | 16)
        out.append(z.decompress(data))
        data = z.unused_data
    return b"".join(out) or data


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``(fields array of (name, value), block binary)`` of every record.  A file is read by
    one task, so files are to be of bounded size, as ``write_warc`` makes them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
        for b in batches:
            for f in b.column(0):
                rows = list(parse_records(unpacked(f.as_py())))
                for s in range(0, len(rows), 1000):
                    some = rows[s : s + 1000]
                    yield pa.RecordBatch.from_arrays([pa.array([[{"name": n, "value": v} for n, v in h] for h, _ in some], kind),
                                                      pa.array([x for _, x in some], pa.binary())], names=["fields", "block"])

    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInArrow(run, "fields array<struct<name:string,value:string>>, block binary"))
