"""WARC derivatives: metadata and plain-text conversion records of response records.

A response record (headers and HTTP message) becomes two records:

* ``metadata`` (application/warc-fields): HTTP status and headers, title, outlinks, the
  digests of the source and the id of the conversion;
* ``conversion`` (text/plain): the visible text of the payload, one line a block.

Both name the response in WARC-Refers-To, carry its target URI and date and their own
block digest; the metadata names the conversion in WARC-Concurrent-To. Record ids are derived from
the source's id, so a task that is run again makes the same records.

Records are written by Spark's text writer: a WARC record ends in two line ends, which
is the writer's separator. Blocks hold no carriage return but at line ends of fields, so
a reader can split the files at record starts and check lengths and digests.

Defined cases: a null or empty payload gives a metadata record and an empty conversion; a
null URL leaves out the target URI; a null id is the id of the URL alone; line ends in a
URL or header are percent-encoded or folded; broken mark-up (open comments, scripts or
tags) runs to the end of the page; repeated rows give equal records; an empty table gives
files without records; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
VERSION = "WARC/1.0"
CRAWL_DATE = "2020-01-01T00:00:00Z"
ROWS = 256

RESPONSE = "record_id string, target_uri string, date string, block_digest string, payload_digest string, block binary"
RECORD = "record_type string, headers array<struct<name:string,value:string>>, block string"

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I)
_BLOCK = re.compile(r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|"
                    r"main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)\b[^>]*(?:>|\Z)", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^>]*(?:>|\Z)")
_TITLE, _TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title\s*>", re.I)
_A, _HREF = re.compile(r"<a\b", re.I), re.compile(r"\bhref\s*=\s*", re.I)
_VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")
_CHARSET = re.compile(r"^content-type\s*:.*?\bcharset\s*=\s*[\"']?([\w.:-]+)", re.I)


def title_of(page: str) -> str:
    """Text between the first title tag and its end, or the end of the page."""
    tag = _TITLE.search(page)
    start = page.find(">", tag.end()) + 1 if tag else 0
    if not start:
        return ""
    end = _TITLE_END.search(page, start)
    return page[start:end.start() if end else len(page)]


def links_of(page: str) -> Iterator[str]:
    """Values of the href of anchor tags. A tag ends at the next ``>`` or the end of the page, and
    no place is looked at twice, so a page of open tags takes linear time."""
    at = 0
    while tag := _A.search(page, at):
        end = page.find(">", tag.end())
        end = len(page) if end < 0 else end
        href = _HREF.search(page, tag.end(), end)
        value = _VALUE.match(page, href.end()) if href else None
        if value:
            yield next(filter(None, value.groups()), "")
        at = value.end() if value else end


def decoded(payload: bytes, http: list[str]) -> str:
    """A page as text, by the charset of its Content-Type header (UTF-8 if none or unknown)."""
    named = next((m[1] for m in map(_CHARSET.match, http) if m), "utf-8")
    try:
        return payload.decode(named, "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def visible_text(page: str) -> str:
    """Text of a page: a line for each block, white space collapsed, entities decoded."""
    s = _BLOCK.sub("\n", _HIDDEN.sub("", page).replace("\n", " "))
    lines = (" ".join(line.split()) for line in entities.unescape(_TAG.sub("", s)).split("\n"))
    return "\n".join(line for line in lines if line)


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(source_id: str, kind: str) -> str:
    h = hashlib.md5(f"{source_id} {kind}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def field(value: str) -> str:
    return " ".join(value.split())


def derive(record_id: str, uri: str | None, date: str | None, block_digest: str | None,
           payload_digest: str | None, block: bytes) -> list[tuple[str, list, str]]:
    """(type, headers, block) of the two records derived from one response."""
    head, _, payload = (block or b"").partition(RECORD_END.encode())
    status, *http = head.decode("latin-1").split(CRLF)
    page = decoded(payload, http)
    text = visible_text(page)
    conversion = derived_id(record_id, "conversion")
    payload_digest = payload_digest or sha1(payload)
    fields = [("http-status", status), *(("http-header", h) for h in http if h),
              ("title", entities.unescape(title_of(page))),
              *(("outlink", link) for link in links_of(_HIDDEN.sub("", page))),
              ("source-block-digest", block_digest or sha1(block or b"")),
              ("source-payload-digest", payload_digest), ("conversion", conversion)]
    about = CRLF.join(f"{k}: {field(v)}" for k, v in fields)

    def record(kind: str, own_id: str, media: str, body: str, more: list) -> tuple:
        raw = body.encode()
        headers = [("WARC-Type", kind), ("WARC-Record-ID", own_id), ("WARC-Refers-To", record_id),
                   ("WARC-Target-URI", uri), ("WARC-Date", date), *more, ("WARC-Block-Digest", sha1(raw)),
                   ("Content-Type", media), ("Content-Length", str(len(raw)))]
        return kind, [(k, v) for k, v in headers if v is not None], body

    return [record("metadata", derived_id(record_id, "metadata"), "application/warc-fields", about,
                   [("WARC-Concurrent-To", conversion)]),
            record("conversion", conversion, "text/plain", text,
                   [("WARC-Source-Payload-Digest", payload_digest)])]


def derivatives(responses: DataFrame) -> DataFrame:
    """Response records (columns of ``RESPONSE``) -> derived records (``RECORD``)."""
    names = [c.split()[0] for c in RESPONSE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.struct([("name", pa.string()), ("value", pa.string())])
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                made = [r for row in b.slice(i, ROWS).to_pylist() for r in derive(*row.values())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m[0] for m in made], pa.string()),
                     pa.array([[{"name": k, "value": v} for k, v in m[1]] for m in made], pa.list_(pair)),
                     pa.array([m[2] for m in made], pa.string())],
                    names=["record_type", "headers", "block"])

    return responses.select(*names).mapInArrow(run, RECORD)


def responses_of_pages(pages: DataFrame, date: str = CRAWL_DATE) -> DataFrame:
    """Response records of a table (page_id, url, html)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    message = F.concat(F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                                F.octet_length(payload).cast("string"), F.lit(RECORD_END)).cast("binary"), payload)
    h = F.md5(F.concat_ws(" ", F.col("page_id").cast("string"), "url").cast("binary"))
    uuid = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in (
        (1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    none = F.lit(None).cast("string")
    return pages.select(uuid.alias("record_id"), uri.alias("target_uri"), F.lit(date).alias("date"),
                        none.alias("block_digest"), none.alias("payload_digest"), message.alias("block"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Writes records as WARC files."""
    lines = F.concat_ws(CRLF, F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])))
    whole = F.concat(F.lit(VERSION + CRLF), lines, F.lit(RECORD_END), F.col("block"))
    records.select(whole.alias("value")).write.option("lineSep", RECORD_END).option(
        "compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Reads what ``write_warc`` wrote: (headers map, block string)."""
    raw = spark.read.option("lineSep", RECORD_END + VERSION + CRLF).text(path)
    record = F.regexp_replace("value", "^" + VERSION + CRLF, "")
    cut = F.instr(F.col("record"), RECORD_END)
    pairs = F.transform(F.split(F.substring("record", F.lit(1), cut - 1), CRLF), lambda line: F.struct(
        F.substring_index(line, ": ", 1).alias("k"), F.substr(line, F.locate(": ", line) + 2).alias("v")))
    rows = (raw.select(record.alias("record")).where("record <> ''")
            .select(F.map_from_entries(pairs).alias("headers"),
                    F.substr("record", cut + len(RECORD_END)).cast("binary").alias("rest")))
    size = F.col("headers")["Content-Length"].cast("int")
    return rows.select("headers", F.substring("rest", F.lit(1), size).cast("string").alias("block"))
