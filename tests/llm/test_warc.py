import base64
import gzip
import hashlib
import random
import time
import zlib
from html.parser import HTMLParser

import pyarrow.fs
import pytest

from threadtone.llm import warc
from threadtone.llm.queries import QUERIES
from threadtone.llm.warc import (
    Headers, _parsed, _records, derive, derived, encoded, page_of, plain_text, read_records, response, scanned,
    write_responses,
)
from threadtone.session import fresh_path


def sha(block):
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain", "plain"),
        ("<p>One</p><p>two &amp; three<br>four</p>", "One\ntwo & three\nfour"),
        ("<script>var t = '</p>';</script>a<!-- b -->c<style>p{}</style>", "ac"),
        ("a <b>bold</b>  word", "a bold word"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<title>T</title>\n\n<div> x </div>", "T\nx"),
    ],
)
def test_plain_text(page, text):
    assert plain_text(page) == text


def test_records_survive_any_cut():
    made = [response(str(i), f"http://h/{i}", "é" * i + "\r\n\r\n" * (i % 3)) for i in range(30)]
    data = b"".join(encoded(*m) for m in made)
    for size in (1, 7, 1000, len(data)):
        found = list(_records(iter([data[i : i + size] for i in range(0, len(data), size)])))
        assert [b for _, b in found] == [b for _, b in made]
        assert [h["WARC-Record-ID"] for h, _ in found] == [dict(h)["WARC-Record-ID"] for h, _ in made]
    with pytest.raises(ValueError):
        list(_records(iter([encoded(made[3][0], made[3][1]), gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nab")])))


def test_header_values_stay_on_their_line():
    headers, block = response("k", "http://h/\r\nWARC-Type: fake", "x")
    found = list(_records(iter([encoded(headers, block)])))[0][0]
    assert found["WARC-Type"] == "response" and "fake" in found["WARC-Target-URI"]


def test_derivatives_refer_to_their_source():
    headers, block = response("k", "http://h/1", '<html lang="de"><title>A &lt;b&gt;</title><a href="/x?a=1&amp;b">y</a>')
    (meta, about), (conversion, text) = ((dict(h), b) for h, b in derived(dict(headers), block))
    source = dict(headers)
    for made, body in ((meta, about), (conversion, text)):
        assert made["WARC-Refers-To"] == source["WARC-Record-ID"]
        assert made["WARC-Target-URI"] == "http://h/1" and made["WARC-Date"] == source["WARC-Date"]
        assert made["WARC-Block-Digest"] == sha(body)
    lines = about.decode().split("\r\n")
    assert f"source-payload-digest: {source['WARC-Payload-Digest']}" in lines
    assert f"source-block-digest: {sha(block)}" in lines
    assert f"conversion: {conversion['WARC-Record-ID']}" in lines
    assert {"title: A <b>", "language: de", "outlink: /x?a=1&b", "http-content-type: text/html; charset=utf-8"} <= set(lines)
    assert text.decode() == "A <b>\ny"


def test_files_round_trip(spark, testdata):
    pages = spark.read.parquet(f"{testdata}/pages.parquet").repartition(3)
    extra = [(None, None, None), (1000, "http://h/", ""), (1001, "http://h/", "x" * 3_000_000), (1001, "http://h/", "x" * 3_000_000)]
    pages = pages.select("page_id", "url", "html").union(spark.createDataFrame(extra, pages.schema))
    pages = pages.selectExpr("*", "'clash' as type", "'clash' as block")
    source, made = fresh_path(spark, "warc"), fresh_path(spark, "warc")
    write_responses(pages, source)
    derive(spark, source, made)
    rows = pages.collect()
    responses = {r.headers["X-Page-Key"]: r for r in read_records(spark, source).collect()}
    assert len(responses) == len(rows) - 1
    found = read_records(spark, made).collect()
    assert len(found) == 2 * len(rows)
    text = {str(r.page_id or "" if r.page_id is None else r.page_id): plain_text(r.html or "") for r in rows}
    for r in found:
        page = r.headers["X-Page-Key"]
        assert r.refers_to == responses[page].record_id and r.uri == responses[page].uri
        assert r.block_digest == sha(bytes(r.block))
        if r.type == "conversion":
            assert bytes(r.block).decode() == text[page]
        else:
            assert f"source-payload-digest: {responses[page].payload_digest}".encode() in bytes(r.block)
    system = pyarrow.fs.LocalFileSystem()
    names = system.get_file_info(pyarrow.fs.FileSelector(made + "/warc"))
    assert names and all(n.path.endswith(".warc.gz") for n in names)
    with system.open_input_stream(names[0].path, compression=None) as data:
        assert gzip.decompress(data.read()).startswith(b"WARC/1.1\r\nWARC-Type: metadata")


def test_no_pages(spark, testdata):
    pages = spark.read.parquet(f"{testdata}/pages.parquet").filter("false")
    source, made = fresh_path(spark, "warc"), fresh_path(spark, "warc")
    write_responses(pages, source)
    derive(spark, source, made)
    assert read_records(spark, made).collect() == []


class Shown(HTMLParser):
    """What a well-formed page shows, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.links, self.hidden = [], [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        self.parts.append("\n" if tag in ("p", "div", "br", "h1", "li") else "")
        if tag == "a" and dict(attrs).get("href"):
            self.links.append(dict(attrs)["href"])

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        self.parts.append("\n" if tag in ("p", "div", "br", "h1", "li") else "")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def test_scan_against_a_parser():
    draw = random.Random(9)
    pieces = ["word ", "a &amp; b", "&#233;", "<p>", "</p>", "<b>", "</b>", "<br>", "\n", "<!-- <p> x -->", " ",
              "<script>var a = '<p>';</script>", "<style>p {}</style>", '<a href="/x?a=1&amp;b=2">', "</a>",
              '<a class="c" href="http://h/">', "<div id='1'>", "</div>", "&nbsp;", "<li>", "<h1>"]
    for _ in range(400):
        page = "".join(draw.choice(pieces) for _ in range(30))
        parser = Shown()
        parser.feed(page)
        parser.close()
        text, _, _, links = scanned(page)
        lines = [" ".join(x.split()) for x in "".join(parser.parts).split("\n")]
        assert text.split("\n") == [x for x in lines if x] or not any(lines)
        assert links == parser.links


@pytest.mark.parametrize(
    "piece", ["<!--", "<a href", "<script ", "<script>", "<title>", "</script ", "<", "&#9", "&#0", " ", "\t<p", "<a href=", "&", "<html lang", "9"]
)
def test_hostile_pages_take_no_time(piece):
    for page in (piece * ((1 << 20) // len(piece)), "&#" + piece * ((1 << 20) // len(piece)) + ">"):
        began = time.perf_counter()
        scanned(page)
        assert time.perf_counter() - began < 2


def test_repeated_headers_stay():
    headers = Headers([("WARC-Record-ID", "<urn:a>"), ("WARC-Concurrent-To", "<urn:b>"), ("WARC-Concurrent-To", "<urn:c>")])
    block = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\n\r\n<p>x"
    (meta, about), _ = derived(headers, block)
    assert [v for n, v in meta if n == "WARC-Concurrent-To"] == ["<urn:b>", "<urn:c>"]
    assert about.decode().count("http-set-cookie") == 2
    assert _parsed(b"x\r\nA: 1\r\nA: 2")["A"] == "1"


def test_encodings_are_undone():
    page = "<p>Grüße, été"
    gzipped = gzip.compress(page.encode("latin-1"))
    chunks = b"".join(b"%x;x=y\r\n%s\r\n" % (len(c), c) for c in (gzipped[:7], gzipped[7:])) + b"0\r\n\r\n"
    http = [("Content-Type", "text/html; charset=ISO-8859-1"), ("Content-Encoding", "gzip"), ("Transfer-Encoding", "chunked")]
    assert page_of(http, chunks) == page
    assert page_of(http[:2], zlib.compress(b"no gzip")).count("\ufffd") == 0
    assert page_of([("content-encoding", "deflate")], zlib.compress(page.encode())) == page
    assert page_of([], b'<meta charset="latin-1">\xe9') == '<meta charset="latin-1">é'
    assert page_of([("Content-Type", "text/html; charset=nonsense")], page.encode()) == page
    assert page_of([("Transfer-Encoding", "chunked")], b"not chunked at all") == "not chunked at all"
    assert page_of([], b"\xff") == "\ufffd"


def test_query_with_odd_pages(spark, testdata, tmp_path):
    rows = [(None, None, None), (7, "http://h/", ""), (7, "http://h/", ""), (8, None, "<p>x " + "&#9" * 5), (9, "u", "y" * 2_000_000)]
    pages = spark.read.parquet(f"{testdata}/pages.parquet")
    spark.createDataFrame(rows, pages.schema).write.parquet(f"{tmp_path}/pages.parquet")
    found = QUERIES["op8_warc"](spark, str(tmp_path)).collect()
    assert len(found) == 10 and sum(r.page_id is None for r in found) == 2
    assert {r.content for r in found if r.page_id == 9 and r.type == "conversion"} == {"y" * 2_000_000}
    spark.createDataFrame([], pages.schema).write.parquet(f"{tmp_path}/none/pages.parquet")
    assert QUERIES["op8_warc"](spark, f"{tmp_path}/none").collect() == []


def test_bytes_after_a_record_are_not_copied_for_each(monkeypatch):
    """A gzip member's end hands back what is left of the bytes given, a copy each time."""
    data = b"".join(encoded([("WARC-Type", "response"), ("N", str(i))], b"block %d" % i) for i in range(3000))
    given = []

    class Counting:
        def __init__(self, wbits):
            self.unpacker = unpackers(wbits=wbits)

        def decompress(self, piece):
            given.append(len(piece))
            return self.unpacker.decompress(piece)

        def __getattr__(self, name):
            return getattr(self.unpacker, name)

    unpackers = zlib.decompressobj
    monkeypatch.setattr(warc.zlib, "decompressobj", Counting)
    found = [(headers["N"], block) for headers, block in warc._records(iter([data[:100_000], data[100_000:]]))]
    assert found == [(str(i), b"block %d" % i) for i in range(3000)]
    assert sum(given) < 3000 * 10_000
