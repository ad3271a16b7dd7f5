"""WARC: responses, and the metadata and conversion records derived from them.

Files hold one gzip member per record, so any record can be read by itself.  Responses
are read from such files, or made from a table of pages; derived records name the
response they refer to, repeat the source's headers that describe it, and carry
digests of their own blocks.  Pages are gone through once, from tag to tag, in a time in
proportion to their length whatever they hold.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadtone.llm.common import files, published

#: The date of responses made from pages that have none.
DATE = "2024-01-01T00:00:00Z"
RECORD = "record_id string, type string, uri string, date string, refers_to string, block_digest string, payload_digest string, content_type string, headers map<string,string>, fields array<struct<name:string,value:string>>, block binary"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # Fixed value: the name space of URLs.
_KEPT = ("WARC-Target-URI", "WARC-Date", "WARC-IP-Address", "WARC-Identified-Payload-Type", "WARC-Concurrent-To")

_MARK = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][\w:-]*)[^>]*>|[/!?][^>]*>)")
_BREAKS = frozenset(
    "p div br h1 h2 h3 h4 h5 h6 li ul ol tr table article section nav header footer title head body "
    "blockquote pre hr option td th".split()
)
_ENDS = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template", "title")}
_HREF = re.compile(r"\bhref\s*=\s*[\"']?([^\"'\s>]+)", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
# Blanks within a line other than the space.
_BLANKS = "\t\r\f\v\xa0"
_LINES = re.compile(r"\n\s+")
_ZEROS, _DIGITS = re.compile(r"&#0+(?=[0-9])"), re.compile(r"&#[1-9][0-9]{7,};?")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
#: Bytes in which a page may name its charset.
_HEAD = 1024
# The end of a gzip member copies what is left of the bytes given, so they are given in pieces.
_PIECE = 1 << 13


def digest(block: bytes) -> str:
    """A block's digest as WARC files write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    """A record's identifier: the same for the same parts, also when a task runs again."""
    # What uuid.uuid5 gives, without an object for each record.
    name = bytearray(hashlib.sha1(_SPACE.bytes + chr(10).join(parts).encode()).digest()[:16])
    name[6], name[8] = name[6] & 0x0F | 0x50, name[8] & 0x3F | 0x80
    digits = name.hex()
    return f"<urn:uuid:{digits[:8]}-{digits[8:12]}-{digits[12:16]}-{digits[16:20]}-{digits[20:]}>"


def _unescaped(text: str) -> str:
    """Entities resolved; numbers beyond all characters are replaced, however long."""
    if "&#" in text:
        text = _DIGITS.sub("\ufffd", _ZEROS.sub("&#", text))
    return html.unescape(text)


def scanned(page: str) -> tuple[str, str | None, str | None, list[str]]:
    """Text, title, language and links of a page, in one pass over its tags.

    Comments and what lies in scripts, styles and templates is hidden.  Where a comment
    or such an element has no end, only its tag is taken out; a ``<`` without a ``>``
    after it is text.
    """
    last, comment, endless = page.rfind(">") + 1, page.rfind("-->"), set()
    title = lang = None
    out, links, at = [], [], 0

    def ending(name: str) -> re.Match | None:
        found = None if name in endless else _ENDS[name].search(page, at)
        if found is None:
            endless.add(name)
        return found

    while found := _MARK.search(page, at, last):
        start, after = found.span()
        if start > at:
            out.append(page[at:start])
        at = after
        hidden, closing, name = found.groups()
        if hidden:
            at = page.find("-->", at) + 3 if comment >= at else page.find(">", at) + 1
            continue
        name = (name or "").lower()
        if name in _BREAKS:
            out.append("\n")
        if closing:
            continue
        if name == "a":
            link = _HREF.search(found[0])
            if link:
                links.append(_unescaped(link[1]))
        elif name == "html" and lang is None:
            known = _LANG.search(found[0])
            lang = known and known[1]
        elif name in _ENDS and (name != "title" or title is None):
            end = ending(name)
            if end and name == "title":
                title = " ".join(_unescaped(page[at : end.start()]).split())
            elif end:
                at = end.end()
    out.append(page[at:])
    text = _unescaped("".join(out))
    for blank in _BLANKS:
        text = text.replace(blank, " ")
    while "  " in text:  # runs get half as long each time
        text = text.replace("  ", " ")
    text = text.replace(" \n", "\n")
    text = _LINES.sub("\n", text).strip()
    return text, title, lang, links


def plain_text(page: str) -> str:
    """What a page shows: markup gone, blocks on lines of their own, entities resolved."""
    return scanned(page)[0]


def _described(title: str | None, lang: str | None, links: list[str]) -> str:
    """Title, language and links of a page, as ``name: value`` lines."""
    lines = [f"title: {title}"] if title is not None else []
    lines += [f"language: {lang}"] if lang else []
    lines += ["outlink: " + _one_line(x) for x in links]
    return "".join(x + "\r\n" for x in lines)


def _whole(payload: bytes) -> bytes:
    """A payload out of its chunks; as it is where it is not in chunks."""
    out, at = [], 0
    while True:
        end = payload.find(b"\r\n", at, at + 64)
        if end < 0:
            return payload
        try:
            size = int(payload[at:end].partition(b";")[0], 16)
        except ValueError:
            return payload
        if size <= 0:
            return b"".join(out)
        out.append(payload[end + 2 : end + 2 + size])
        at = end + 4 + size
        if at > len(payload) + 2:
            return payload


def page_of(http: list[tuple[str, str]], payload: bytes) -> str:
    """The page that a response delivered: chunks joined, compression undone, decoded.

    Compression other than gzip and deflate, and what does not decompress, stays as it
    is.  The charset is the header's, else the one that the page's beginning names, else
    UTF-8, and UTF-8 for one that is unknown; what does not decode is replaced.
    """
    named: dict[str, list[str]] = {}
    for name, value in http:
        named.setdefault(name.lower(), []).append(value)
    if "chunked" in ",".join(named.get("transfer-encoding", [])).lower():
        payload = _whole(payload)
    for coding in reversed(",".join(named.get("content-encoding", [])).lower().split(",")):
        for bits in {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(coding.strip(), ()):
            try:
                payload = zlib.decompress(payload, bits)
                break
            except zlib.error:
                pass
    said = _CHARSET.search(" ".join(named.get("content-type", []))) or _CHARSET.search(payload[:_HEAD].decode("latin-1"))
    try:
        return payload.decode(said[1] if said else "utf-8", errors="replace")
    except (LookupError, UnicodeError):
        return payload.decode(errors="replace")


def _one_line(value: str) -> str:
    return " ".join(value.split())


def encoded(headers: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", *(f"{n}: {_one_line(v)}" for n, v in headers), f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(level, wbits=31)
    raw = "\r\n".join(lines).encode() + block + b"\r\n\r\n"
    return packer.compress(raw) + packer.flush()


def response(page: str, uri: str, content: str, date: str = DATE) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and block of the response that delivered ``content``."""
    payload = content.encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + payload
    return [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id("response", page, uri)),
        ("WARC-Target-URI", uri),
        ("WARC-Date", date),
        ("WARC-Block-Digest", digest(block)),
        ("WARC-Payload-Digest", digest(payload)),
        ("Content-Type", "application/http; msgtype=response"),
    ], block


class Headers(dict[str, str]):
    """The first value of every header; ``pairs`` has all of them in order."""

    def __init__(self, pairs: Iterable[tuple[str, str]]) -> None:
        self.pairs = list(pairs)
        super().__init__(reversed(self.pairs))


def _parsed(head: bytes) -> Headers:
    lines = (line.partition(":") for line in head.decode(errors="replace").split("\r\n")[1:] if line)
    return Headers((name.strip(), value.strip()) for name, _, value in lines)


def _records(data: Iterator[bytes]) -> Iterator[tuple[Headers, bytes]]:
    """The records of a stream of gzip members; holds one record at a time."""
    buffer = bytearray()

    def inflated() -> Iterator[bytes]:
        unpacker = zlib.decompressobj(wbits=31)
        for chunk in data:
            for at in range(0, len(chunk), _PIECE):
                piece = chunk[at : at + _PIECE]
                while piece:
                    yield unpacker.decompress(piece)
                    piece = unpacker.unused_data
                    if unpacker.eof:
                        unpacker = zlib.decompressobj(wbits=31)

    headers, need = None, 0
    for part in inflated():
        buffer += part
        while True:
            if headers is None:
                end = buffer.find(b"\r\n\r\n")
                if end < 0:
                    break
                headers = _parsed(bytes(buffer[:end]))
                del buffer[: end + 4]
                need = int(headers.get("Content-Length", 0))
            if len(buffer) < need + 4:
                break
            yield headers, bytes(buffer[:need])
            del buffer[: need + 4]
            headers = None
    if headers is not None or buffer.strip():
        raise ValueError("a WARC file ends within a record")


def _chunks(system: pyarrow.fs.FileSystem, path: str, size: int = 1 << 20) -> Iterator[bytes]:
    with system.open_input_stream(path, compression=None) as data:
        while chunk := data.read(size):
            yield chunk


def write_responses(pages: DataFrame, folder: str, key: str = "page_id", uri: str = "url", content: str = "html") -> None:
    """The pages as response records, a file for every task; null columns are empty.

    Other columns are not read, whatever their names.
    """
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((key, "k"), (uri, "u"), (content, "c"))]

    def made(row: dict) -> tuple[list[tuple[str, str]], bytes]:
        headers, block = response(row["k"], row["u"], row["c"])
        return [*headers, ("X-Page-Key", row["k"])], block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _written((made(row) for batch in batches for row in _rows(batch)), folder)

    # The summary is stored so that the files are written once.
    pages.select(*columns).mapInArrow(run, "file string, records long").write.parquet(f"{folder}/summary")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    columns = {name: batch.column(name) for name in batch.schema.names}
    for i in range(batch.num_rows):
        yield {name: column[i].as_py() for name, column in columns.items()}


def _written(records: Iterator[tuple[list[tuple[str, str]], bytes]], folder: str) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    first = next(records, None)
    if first is None:
        return
    name, count = f"{context.partitionId():06d}.warc.gz", 0
    with published(f"{folder}/warc", name, str(context.taskAttemptId())) as out:
        for headers, block in (x for xs in ([first], records) for x in xs):
            out.write(encoded(headers, block))
            count += 1
    yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([count], pa.int64())})


def _paths(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder, each in a task of its own."""
    summary = spark.read.schema("file string, records long").parquet(f"{folder}/summary")
    return summary.select("file").repartitionByRange(max(1, summary.count()), "file")


def read_records(spark: SparkSession, folder: str, kinds: tuple[str, ...] = ()) -> DataFrame:
    """The records of the files in a folder, of the given types or all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = files(f"{folder}/warc")
        kind = pa.map_(pa.string(), pa.string())
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                for headers, block in _records(_chunks(system, f"{path}/{name}")):
                    if kinds and headers.get("WARC-Type") not in kinds:
                        continue
                    rows.append((headers, block))
                    size += len(block)
                    if size > 8 << 20:
                        yield _batch(rows, kind)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, kind)

    return _paths(spark, folder).mapInArrow(run, RECORD)


def _pairs(lists: list[list[tuple[str, str]]]) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Offsets, names and values of lists of pairs, as flat arrays."""
    offsets = [0, *accumulate(map(len, lists))]
    flat = [pair for pairs in lists for pair in pairs]
    return pa.array(offsets, pa.int32()), pa.array([n for n, _ in flat], pa.string()), pa.array([v for _, v in flat], pa.string())


def _batch(rows: list[tuple[Headers, bytes]], kind: pa.DataType) -> pa.RecordBatch:
    named = {
        "record_id": "WARC-Record-ID", "type": "WARC-Type", "uri": "WARC-Target-URI", "date": "WARC-Date",
        "refers_to": "WARC-Refers-To", "block_digest": "WARC-Block-Digest",
        "payload_digest": "WARC-Payload-Digest", "content_type": "Content-Type",
    }
    columns = [pa.array([h.get(field) for h, _ in rows], pa.string()) for field in named.values()]
    first = _pairs([list(h.items()) for h, _ in rows])
    columns.append(pa.MapArray.from_arrays(*first).cast(kind))
    offsets, names, values = _pairs([h.pairs for h, _ in rows])
    columns.append(pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([names, values], ["name", "value"])))
    columns.append(pa.array([b for _, b in rows], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, [*named, "headers", "fields", "block"])


def derived(headers: dict[str, str], block: bytes) -> list[tuple[list[tuple[str, str]], bytes]]:
    """The metadata and the conversion record of one response.

    Both refer to the response and repeat its address and date; the metadata keeps the
    response's digests and every transferred header as well, repeated ones too.
    """
    source = headers.get("WARC-Record-ID", "")
    head, _, payload = block.partition(b"\r\n\r\n")
    http = _parsed(head).pairs
    pairs = getattr(headers, "pairs", list(headers.items()))
    kept = [(n, v) for n, v in pairs if n in (*_KEPT, "X-Page-Key")]
    about = "".join(
        f"{name}: {headers[field]}\r\n"
        for name, field in (("source-block-digest", "WARC-Block-Digest"), ("source-payload-digest", "WARC-Payload-Digest"))
        if field in headers
    )
    about += "".join(f"http-{n.lower()}: {v}\r\n" for n, v in http)
    shown, *rest = scanned(page_of(http, payload))
    text, made = shown.encode(errors="replace"), []
    meta_id, text_id = record_id("metadata", source), record_id("conversion", source)
    about = (about + f"conversion: {text_id}\r\n" + _described(*rest)).encode(errors="replace")
    for kind, own, content, body in (
        ("metadata", meta_id, "application/warc-fields", about),
        ("conversion", text_id, "text/plain; charset=utf-8", text),
    ):
        made.append((
            [
                ("WARC-Type", kind),
                ("WARC-Record-ID", own),
                ("WARC-Refers-To", source),
                *kept,
                ("WARC-Block-Digest", digest(body)),
                ("Content-Type", content),
            ],
            body,
        ))
    return made


def derive(spark: SparkSession, responses: str, folder: str) -> None:
    """Write the derivatives of every response in the files of ``responses``.

    File by file: a file of responses becomes a file of twice as many records in the
    same order.  Other record types are passed over.  Repeated responses have equal
    derivatives; empty payloads give empty conversions.  A task holds one response at a
    time, so very long pages need a few times their length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = files(f"{responses}/warc")
        for batch in batches:
            for name in batch.column(0).to_pylist():
                count = 0
                with published(f"{folder}/warc", name, str(TaskContext.get().taskAttemptId())) as out:
                    for headers, block in _records(_chunks(system, f"{path}/{name}")):
                        if headers.get("WARC-Type") == "response":
                            for made in derived(headers, block):
                                out.write(encoded(*made))
                                count += 1
                yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([count], pa.int64())})

    _paths(spark, responses).mapInArrow(run, "file string, records long").write.parquet(f"{folder}/summary")
