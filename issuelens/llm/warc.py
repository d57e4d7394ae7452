"""WARC derivatives: responses become linked metadata and plain-text conversion records.

A record is a row: page_id, warc_type, record_id, refers_to, target_uri, date, content_type,
block (binary), block_digest, payload_digest, headers (array of name/value, in order).  Every
response yields two records.  The conversion holds the page's text; the metadata holds, as JSON,
the source's WARC headers and HTTP headers (as lists of pairs, in order, so repeated names stay), HTTP
status, charset, title, language and links, its digests and the conversion's id.  Both refer to the response (WARC-Refers-To, with its target URI and date) and
keep the source's payload digest and headers; digests are SHA-1 in base 32, as is usual.

Everything is one narrow pass per row: no shuffle, and a page is the most a task holds.
``write_warc`` writes WARC files, one per partition, plain or compressed, and ``read_warc`` reads them
back record by record: plain files are split among tasks, and no task holds more than a record.

A payload is decoded by the charset of its Content-Type, else of its ``meta`` element, else as UTF-8;
bytes that the charset does not have become U+FFFD; an unknown charset means UTF-8.

Record ids are made from the content (same rows, same ids), so a lost and repeated task yields
the same records.  Defined results: a NULL url is an empty target URI; NULL or empty html is an
empty payload with empty text and no links; broken markup is read as far as it goes (an unclosed
comment, script or style reaches to the end, ``<`` not before a tag name is text).  Repeated
rows yield equal records.  Other columns of the input are not read.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html as entities
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens.llm.text import in_arrow, read_table, schema_of

VERSION = "WARC/1.1"
NO_DATE = "1970-01-01T00:00:00Z"        # the pages table has no fetch time
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:record")

RECORD = ("warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
          "block binary, block_digest string, payload_digest string, headers array<struct<name:string,value:string>>")

HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
# Elements that begin and end lines of text (fixed values: HTML's block-level elements and breaks).
BLOCK = re.compile(r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|"
                   r"legend|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)(?=[\s/>])[^>]*>", re.I)
TAG = re.compile(r"<[/!?a-zA-Z][^>]*(?:>|\Z)")
SPACES = re.compile(r"[^\S\n]+")
TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title|\Z)", re.S | re.I)
LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I)
CHARSET = re.compile(rb"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
META_CHARSET = re.compile(rb"<meta\b[^>]*?charset\s*=\s*[\"']?([\w.:-]+)", re.I)
LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join(map(str, parts)))}>"


def plain_text(page: str) -> str:
    """The visible text: a line per block, white space collapsed, empty lines left out."""
    text = TAG.sub("", BLOCK.sub("\n", HIDDEN.sub(" ", page).replace("\n", " ")))
    lines = SPACES.sub(" ", entities.unescape(text).replace("\r", " ")).split("\n")
    return "\n".join(x for x in map(str.strip, lines) if x)


def described(page: str, base: str) -> dict:
    """Title, language and links of a page."""
    seen = HIDDEN.sub(" ", page)
    title, lang = TITLE.search(seen), LANG.search(seen)
    links = []
    for found in LINK.findall(seen):
        href = entities.unescape(next(filter(None, found), ""))
        try:
            links.append(urljoin(base, href))
        except ValueError:                  # not a URL: kept as it stands
            links.append(href)
    return {"title": " ".join(entities.unescape(title[1]).split()) if title else None, "lang": lang[1] if lang else None, "links": links}


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP message."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    return lines[0], [tuple(map(str.strip, x.partition(":")[::2])) for x in lines[1:] if x], payload


def charset_of(http: list[tuple[str, str]], payload: bytes) -> str:
    """The charset that a page declares, as Python names it."""
    declared = [CHARSET.search(v.encode()) for n, v in http if n.lower() == "content-type"]
    for found in [*declared, META_CHARSET.search(payload[:4096])]:     # standards put the element in the first bytes
        if found:
            try:
                return codecs.lookup(found[1].decode("ascii", "replace")).name
            except LookupError:
                pass
    return "utf-8"


def record(kind: str, rid: str, refers_to: str | None, uri: str, date: str, content_type: str, block: bytes,
           payload_digest: str | None, more: list[tuple[str, str]] = ()) -> tuple:
    headers = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", date), ("WARC-Target-URI", uri)]
    if refers_to:
        headers.append(("WARC-Refers-To", refers_to))
    if payload_digest:
        headers.append(("WARC-Payload-Digest", payload_digest))
    headers += [*more, ("WARC-Block-Digest", digest(block)), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    return kind, rid, refers_to, uri, date, content_type, block, digest(block), payload_digest, [{"name": n, "value": v} for n, v in headers]


def response(page_id: object, url: str | None, page: str | None, date: str = NO_DATE) -> tuple:
    payload = (page or "").encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    body = digest(payload)
    return record("response", record_id("response", page_id, url, body), None, url or "", date, "application/http;msgtype=response", block, body)


def derived(source: dict) -> list[tuple]:
    """The conversion and metadata records of a response record."""
    status, http, payload = http_parts(source["block"])
    charset = charset_of(http, payload)
    page, uri, rid = payload.decode(charset, errors="replace"), source["target_uri"] or "", source["record_id"]
    about = [("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", source["date"])]
    facts = described(page, uri)
    language = [("WARC-Identified-Content-Language", facts["lang"])] if facts["lang"] else []
    text = record("conversion", record_id("conversion", rid), rid, uri, source["date"], "text/plain; charset=utf-8",
                  plain_text(page).encode(), source["payload_digest"], about + language)
    envelope = {"refers_to": rid, "conversion": text[1], "warc_headers": [[h["name"], h["value"]] for h in source["headers"]],
                "http_status": status, "http_headers": http, "charset": charset, "payload_length": len(payload), **facts}
    meta = record("metadata", record_id("metadata", rid), rid, uri, source["date"], "application/json",
                  json.dumps(envelope, ensure_ascii=False, sort_keys=True).encode(), source["payload_digest"], about)
    return [meta, text]


def record_schema(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("page_id", kind), *T.StructType.fromDDL(RECORD).fields])


def as_batch(ids: pa.Array, made: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*made)) or [[]] * (len(schema) - 1)
    return pa.RecordBatch.from_arrays([ids, *[pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:])]], schema=schema)


def responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", date: str = NO_DATE) -> DataFrame:
    """Response records of a table of fetched pages."""
    out = record_schema(pages.schema[page_id].dataType)
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield as_batch(b.column(0), [response(i, u, p, date) for i, u, p in zip(*[c.to_pylist() for c in b.columns])], schema)

    return in_arrow(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html")), run, out)


def derivatives(records: DataFrame) -> DataFrame:
    """The metadata and conversion records of the response records among ``records``."""
    out = record_schema(records.schema["page_id"].dataType)
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            twice = pa.array([i for i in range(len(rows)) for _ in range(2)], pa.int64())
            yield as_batch(b.column(0).take(twice), [r for row in rows for r in derived(row)], schema)

    return in_arrow(records.filter("warc_type = 'response'").select(*[f.name for f in out]), run, out)


def serialized(headers: list[dict], block: bytes) -> bytes:
    """A record as it stands in a WARC file."""
    head = "".join([f"{VERSION}\r\n", *[f"{h['name']}: {h['value']}\r\n" for h in headers], "\r\n"])
    return head.encode() + block + b"\r\n\r\n"


# What lies between two records: the end of one and the beginning of the next one's version line.
BETWEEN = "\r\n\r\nWARC/1."


def parsed(record: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and block of a record, as cut at ``BETWEEN``."""
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = [tuple(map(str.strip, x.partition(":")[::2])) for x in head.decode(errors="replace").split("\r\n")[1:]]
    size = int(next((v for n, v in headers if n.lower() == "content-length"), 0))
    if len(rest) < size:
        raise ValueError(f"a record of {size} bytes ends after {len(rest)}: its block holds a record's beginning, or the file is cut short")
    return headers, rest[:size]


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Write records as WARC files below ``path``, one per partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [serialized(h, x)[:-4] for h, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])

    in_arrow(records.select("headers", "block"), run, "value binary").select(F.col("value").cast("string")) \
        .write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records (page_id NULL) of the WARC files below ``path``, compressed ones (``.gz``) included.

    Spark cuts the files at the line between records, so a plain file is shared by many tasks.  A block
    that holds such a line itself is an error, as is a file that is cut short.
    """
    out = record_schema(T.LongType())
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for content in b.column(0):
                headers, block = parsed(content.as_py())
                h = dict(reversed(headers))              # the first of repeated names
                made.append((h.get("WARC-Type"), h.get("WARC-Record-ID"), h.get("WARC-Refers-To"), h.get("WARC-Target-URI"), h.get("WARC-Date"),
                             h.get("Content-Type"), block, h.get("WARC-Block-Digest"), h.get("WARC-Payload-Digest"),
                             [{"name": n, "value": v} for n, v in headers]))
            yield as_batch(pa.array([None] * len(made), pa.int64()), made, schema)

    cut = spark.read.option("lineSep", BETWEEN).text(path).select(F.col("value").cast("binary").alias("record"))
    return in_arrow(cut.filter(F.length("record") > 4), run, out)


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages."""
    found = derivatives(responses(read_table(spark, sf_dir, "pages")))
    return found.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "content_type", "block_digest", "payload_digest",
                        F.length("block").cast("long").alias("content_length"), F.decode("block", "UTF-8").alias("block"))
