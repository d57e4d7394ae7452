"""WARC derivatives: text against a parser, links and headers, files read back, defined results."""

import hashlib
import json
import os
import tempfile
import base64
import codecs
from html.parser import HTMLParser

import pytest

from conftest import SF_SMALL
from issuelens.llm import warc


class Visible(HTMLParser):
    """Words of a page, by Python's own parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style")
        self.words.append(" ")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style")
        self.words.append(" ")

    def handle_data(self, data):
        if not self.off:
            self.words.append(data)


def test_text_matches_a_parser(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    for p in pages:
        seen = Visible()
        seen.feed(p.html)
        seen.close()
        # inline tags cut no words here, but the parser above puts a space at every tag
        assert warc.plain_text(p.html).replace("\n", " ").replace(" ", "") == "".join("".join(seen.words).split())


def test_records_are_linked_and_digests_right(spark):
    rows = warc.op3_warc_derivatives(spark, SF_SMALL).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    assert len(rows) == 2 * len(pages) and len({r.record_id for r in rows}) == len(rows)
    by = {(r.page_id, r.warc_type): r for r in rows}
    for i, page in pages.items():
        meta, text = by[i, "metadata"], by[i, "conversion"]
        sha = "sha1:" + base64.b32encode(hashlib.sha1(page.html.encode()).digest()).decode()
        assert meta.refers_to == text.refers_to and meta.payload_digest == text.payload_digest == sha
        facts = json.loads(meta.block)
        assert facts["conversion"] == text.record_id and facts["refers_to"] == text.refers_to
        assert ["WARC-Payload-Digest", sha] in facts["warc_headers"] and ["WARC-Target-URI", page.url] in facts["warc_headers"]
        assert facts["http_status"] == "HTTP/1.1 200 OK" and ["Content-Length", str(len(page.html.encode()))] in facts["http_headers"]
        assert len(facts["links"]) == page.html.count("<a href=") and all(x.startswith("http") for x in facts["links"])
        assert text.content_length == len(text.block.encode()) and text.block_digest == warc.digest(text.block.encode())


def test_files_read_back(spark):
    records = warc.responses(spark.read.parquet(f"{SF_SMALL}/pages.parquet"))
    both = records.unionByName(warc.derivatives(records))
    path = os.path.join(tempfile.mkdtemp(prefix="warc-"), "out")
    warc.write_warc(both, path)
    back = warc.read_warc(spark, path)
    cols = [c for c in both.columns if c != "page_id"]
    key = lambda r: r.record_id
    assert sorted(both.select(cols).collect(), key=key) == sorted(back.select(cols).collect(), key=key)
    again = warc.derivatives(back)          # derivatives of what was read
    assert sorted(r.record_id for r in again.collect()) == sorted(r.record_id for r in both.filter("warc_type <> 'response'").collect())


def test_defined_results(spark):
    rows = [(1, None, None, "x"), (2, "http://a.example/", "", "x"), (3, "http://a.example/b", "<p>1 < 2 &amp; 3<br>x<!-- open <p>gone", "x"),
            (3, "http://a.example/b", "<p>1 < 2 &amp; 3<br>x<!-- open <p>gone", "x"), (None, "::bad[", "<a href='c d'>t</a><a href=//[x>u</a>", "x"),
            (4, "http://a.example/", "<script>var s='<p>'; never closed", "x"), (5, "http://a.example/", "word " * 300_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    found = warc.derivatives(warc.responses(pages)).collect()
    assert len(found) == 2 * len(rows)
    text = {r.page_id: r.block.decode() for r in found if r.warc_type == "conversion"}
    assert text[1] == text[2] == text[4] == "" and text[3] == "1 < 2 & 3\nx" and text[None] == "tu" and len(text[5]) == 1_499_999
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


def source(payload, http, more=()):
    block = b"HTTP/1.1 200 OK\r\n" + http + b"\r\n\r\n" + payload
    return warc.record("response", "<urn:uuid:1>", None, "http://a.example/", warc.NO_DATE, "application/http;msgtype=response", block,
                       warc.digest(payload), list(more))


def test_repeated_headers_stay_in_order(spark):
    made = source(b"x", b"Set-Cookie: a=1\r\nContent-Type: text/html\r\nSet-Cookie: b=2", [("WARC-Concurrent-To", "<urn:uuid:2>"), ("WARC-Concurrent-To", "<urn:uuid:3>")])
    records = spark.createDataFrame([(1, *made)], warc.record_schema(warc.T.LongType()))
    for rows in (records, ):
        meta = json.loads(warc.derivatives(rows).filter("warc_type = 'metadata'").first().block)
        assert [v for n, v in meta["http_headers"] if n == "Set-Cookie"] == ["a=1", "b=2"]
        assert [v for n, v in meta["warc_headers"] if n == "WARC-Concurrent-To"] == ["<urn:uuid:2>", "<urn:uuid:3>"]


def test_declared_charsets(spark):
    cases = [("caf\u00e9", "iso-8859-1", b"Content-Type: text/html; charset=ISO-8859-1", b""), ("\u65e5\u672c", "shift_jis", b"X: y", b"<meta charset='Shift_JIS'>"),
             ("caf\u00e9", "utf-8", b"Content-Type: text/html", b""), ("\u00df", "utf-8", b"Content-Type: text/html; charset=no-such", b"")]
    for i, (text, code, http, meta) in enumerate(cases):
        made = source(meta + b"<p>" + text.encode(code), http)
        found = warc.derived(dict(zip([f.name for f in warc.T.StructType.fromDDL(warc.RECORD).fields], made)))
        assert found[1][6].decode() == text and json.loads(found[0][6])["charset"] == codecs.lookup(code).name, i


def test_compressed_files_and_odd_bytes_read_back(spark):
    latin = source("caf\u00e9 \r\n\r\n WARC/1".encode("latin-1"), b"Content-Type: text/html; charset=latin-1")
    pages = spark.createDataFrame([(i, f"http://a.example/{i}", f"<p>{i}") for i in range(40)], "page_id long, url string, html string")
    records = warc.responses(pages).unionByName(spark.createDataFrame([(99, *latin)], warc.record_schema(warc.T.LongType()))).coalesce(2)
    for compression in ("none", "gzip"):
        path = os.path.join(tempfile.mkdtemp(prefix="warc-"), "out")
        warc.write_warc(records, path, compression)
        back = warc.read_warc(spark, path)
        assert sorted((r.record_id, bytes(r.block)) for r in back.collect()) == sorted((r.record_id, bytes(r.block)) for r in records.collect())
    cut = source(b"before\r\n\r\nWARC/1.1 inside", b"X: y")
    path = os.path.join(tempfile.mkdtemp(prefix="warc-"), "out")
    warc.write_warc(spark.createDataFrame([(1, *cut)], warc.record_schema(warc.T.LongType())), path)
    with pytest.raises(Exception, match="its block holds a record's beginning"):
        warc.read_warc(spark, path).collect()
