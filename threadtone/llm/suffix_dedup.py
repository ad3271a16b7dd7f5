"""Suffix-array dedup: bytes that a document with a smaller key has had before.

A byte goes if a string of ``WINDOW`` bytes covers it that also starts in a document
with a smaller key.  Equal strings are brought together by their anchor, the smallest
hash among their short grams: every run of strings with one anchor is a segment, and
anchors of only one document are left out.  Segments meet by anchor; equal segments
become one; and where different segments share an anchor, their suffix arrays, built by
linear grouping (``suffix_array``), bring equal strings next to each other.

Documents, by a hash of key and text, and anchors are dealt into groups and buckets of about
``GROUP_BYTES`` of text each.  Rows of one key spread over the groups; only rows that are
equal in key and text share one.  Skew of anchors is met before the shuffle: a task tells a bucket once of an anchor that several of its documents have, and sends one
of its equal segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadtone.llm.common import stored, text_or_empty
from threadtone.llm.suffix_array import suffix_arrays

WINDOW = 50
#: Bytes of a gram; the anchors of large problems are found anew with the long one.
GRAM, LONG_GRAM = 20, 40
GROUP_BYTES = 8 << 20
#: Texts are hashed in pieces of about so many bytes.
PIECE = 1 << 20
#: Rows whose anchors are announced together.
ROWS = 3000
#: Symbols that are sorted side by side, and segments from which a problem is cut anew.
BATCH, CROWD = 1 << 19, 12
_NOBODY = np.iinfo(np.int64).min
_PARTS = "kind int, part int, payload binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from every position, built by doubling."""
    found, length = _mixed(data.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    while length < size:
        step = min(length, size - length)
        found = _mixed(found[:-step] * np.uint64(0x9E3779B97F4A7C15) + found[step:])
        length += step
    return found


def _sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    length = 1
    while length < size:
        step = min(length, size - length)
        values, length = np.minimum(values[:-step], values[step:]), length + step
    return values


def runs_of(data: np.ndarray, bounds: np.ndarray, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``text, start, windows, anchor``: the windows of texts, in runs of equal anchor.

    ``bounds`` cut ``data`` into texts.  Starts count from the beginning of ``data``.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    at, count = 0, len(bounds) - 1
    while at < count:
        stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PIECE, side="right")) - 1)
        # A text longer than a piece is cut into pieces that overlap by a window.
        for low in range(int(bounds[at]), max(int(bounds[stop]), int(bounds[at]) + 1), PIECE if stop == at + 1 else 1 << 62):
            high = min(int(bounds[stop]), low + PIECE + WINDOW - 1) if stop == at + 1 else int(bounds[stop])
            if high - low < WINDOW:
                continue
            least = _sliding_least(_gram_hashes(data[low:high], gram), WINDOW - gram + 1)
            owner = np.repeat(np.arange(at, stop), np.diff(np.clip(bounds[at : stop + 1], low, high)))
            inside = np.nonzero(owner[: len(least)] == owner[WINDOW - 1 :])[0]
            if not len(inside):
                continue
            anchor, text = least[inside], owner[inside]
            first = np.ones(len(inside), bool)
            first[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
            first = np.nonzero(first)[0]
            windows = np.diff(np.append(first, len(inside)))
            parts.append((text[first], inside[first] + low, windows, anchor[first]))
        at = stop
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(p) for p in zip(*parts))


def _packed(*arrays: np.ndarray, raw: bytes = b"") -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    return zstandard.compress(head + b"".join(a.tobytes() for a in arrays) + raw, 1)


def _unpacked(payload: bytes, *types: type) -> list[np.ndarray]:
    """The arrays of a payload, and what follows them as bytes if no type is left."""
    data = zstandard.decompress(payload)
    sizes = np.frombuffer(data, np.int64, len(types) + 1)[1:]
    at, found = 8 * (len(types) + 1), []
    for kind, size in zip(types, sizes):
        found.append(np.frombuffer(data, kind, int(size) // np.dtype(kind).itemsize, at))
        at += int(size)
    return [*found, data[at:]]


def _bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, and the bounds of its values."""
    if isinstance(column, pa.ChunkedArray):
        parts = [_bytes_of(c) for c in column.chunks] or [(np.zeros(0, np.uint8), np.zeros(1, np.int64))]
        sizes = np.concatenate([np.diff(b) for _, b in parts])
        return np.concatenate([d for d, _ in parts]), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def _names(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """An anchor's bucket in the upper half, and what tells it apart there in the lower."""
    anchor = _mixed(anchor)  # The smallest of many hashes has few high bits.
    return (anchor % np.uint64(buckets) << np.uint64(32)) | (anchor >> np.uint64(32))


def _parts(kind: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(rows), kind, np.int32)),
            pa.array([p for p, _ in rows], pa.int32()),
            pa.array([b for _, b in rows], pa.binary()),
        ],
        ["kind", "part", "payload"],
    )


def _slices(values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The runs of equal values of a sorted array."""
    starts = np.nonzero(np.diff(values, prepend=values[:1] - 1 if len(values) else 0))[0]
    for a, b in zip(starts, np.append(starts[1:], len(values))):
        yield int(values[a]), slice(int(a), int(b))


def _announced(batch: pa.RecordBatch, groups: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Kind 0, to buckets: anchors and who has them.  Kind 1, to groups: shared anchors."""
    group, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    text, _, _, anchor = runs_of(*_bytes_of(batch.column(2)))
    name, owner, home = _names(anchor, buckets), ids[text], group[text]
    order = np.lexsort((owner, name))
    name, owner, home = name[order], owner[order], home[order]
    fresh = np.ones(len(name), bool)
    fresh[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
    name, owner, home = name[fresh], owner[fresh], home[fresh]
    new = np.ones(len(name), bool)
    new[1:] = name[1:] != name[:-1]
    first = np.nonzero(new)[0]
    count = np.diff(np.append(first, len(name)))
    many = np.repeat(count > 1, count)
    known = np.unique(np.stack([home[many].astype(np.uint64), name[many]], 1), axis=0)
    yield _parts(1, [(g, _packed(known[s, 1].copy())) for g, s in _slices(known[:, 0].astype(np.int64))])
    name, owner, home = name[first], np.where(count > 1, _NOBODY, owner[first]), home[first]
    bucket = (name >> np.uint64(32)).astype(np.int64)
    low = name.astype(np.uint32)
    yield _parts(0, [(b, _packed(low[s], owner[s], home[s].astype(np.int32))) for b, s in _slices(bucket)])


def _shared(bucket: int, payloads: list[bytes]) -> list[tuple[int, bytes]]:
    """To every group, the anchors of a bucket that other documents have as well."""
    parts = [_unpacked(p, np.uint32, np.int64, np.int32)[:3] for p in payloads]
    low, owner, home = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(low, kind="stable")
    low, owner, home = low[order], owner[order], home[order]
    first = np.nonzero(np.diff(low.astype(np.int64), prepend=-1))[0]
    count = np.diff(np.append(first, len(low)))
    smallest, largest = np.minimum.reduceat(owner, first), np.maximum.reduceat(owner, first)
    shared = np.repeat((smallest != largest) | (smallest == _NOBODY), count) & (owner != _NOBODY)
    name = np.uint64(bucket << 32) | low[shared].astype(np.uint64)
    told = np.unique(np.stack([home[shared].astype(np.uint64), name], 1), axis=0)
    return [(g, _packed(told[s, 1].copy())) for g, s in _slices(told[:, 0].astype(np.int64))]


def _segments(docs: pa.Table, told: pa.Table, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """Kind 0, to buckets: segments.  Kind 1, to the group itself: spans known already."""
    if not docs.num_rows or not told.num_rows:
        return
    group = docs.column("part")[0].as_py()
    ids, marks = docs.column("id").to_numpy(), docs.column("t").to_numpy()
    data, bounds = _bytes_of(docs.column("data"))
    known = np.unique(np.concatenate([_unpacked(p.as_py(), np.uint64)[0] for p in told.column("payload")]))
    text, start, windows, anchor = runs_of(data, bounds)
    name = _names(anchor, buckets)
    near = np.minimum(np.searchsorted(known, name), len(known) - 1)
    kept = np.nonzero(known[near] == name)[0]
    # Small keys first, so that the first of equal segments is the one to send.
    kept = kept[np.lexsort((start[kept], ids[text[kept]], name[kept]))]
    text, start, windows, name = text[kept], start[kept], windows[kept], name[kept]
    owner, mark, offset = ids[text], marks[text], start - bounds[text]
    length = windows + WINDOW - 1
    raw = data.tobytes()
    seen: dict[bytes, int] = {}
    sent = np.ones(len(text), bool)
    for i, (a, n, who) in enumerate(zip(start.tolist(), length.tolist(), owner.tolist())):
        sent[i] = seen.setdefault(raw[a : a + n], who) == who
    gone = ~sent
    if gone.any():
        yield 1, group, _packed(owner[gone], mark[gone], offset[gone], (offset + length)[gone])
    chosen = np.nonzero(sent)[0]
    bucket = (name[chosen] >> np.uint64(32)).astype(np.int64)
    for b, s in _slices(bucket):
        at = chosen[s]
        body = b"".join([raw[a : a + n] for a, n in zip(start[at].tolist(), length[at].tolist())])
        arrays = owner[at], mark[at], offset[at], length[at].astype(np.int32), np.full(len(at), group, np.int32)
        yield 0, b, _packed(name[at].astype(np.uint32), *arrays, raw=body)


Spans = tuple[np.ndarray, np.ndarray, np.ndarray]


def _joined(parts: list[Spans]) -> Spans:
    none = tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(none, *parts)) if parts else none


def repeated_spans(segments: list[bytes], owners: np.ndarray, problem: np.ndarray) -> Spans:
    """``segment, start, stop``: what strings of a smaller owner in the same problem cover.

    ``problem`` numbers the problems, in rising order.
    """
    sizes = np.array([len(s) for s in segments], np.int64)
    first = np.nonzero(np.diff(problem, prepend=-1))[0]
    last = np.append(first[1:], len(problem))
    room = np.add.reduceat(sizes + 1, first) + 1 if len(first) else np.zeros(0, np.int64)
    # Problems of like size take their steps together.
    order = np.argsort(room, kind="stable")
    total = np.cumsum(room[order])
    found, at = [], 0
    while at < len(order):
        done = total[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(total, done + BATCH, side="right")))
        found.append(_side_by_side(segments, sizes, owners, first[order[at:upto]], last[order[at:upto]]))
        at = upto
    return _joined(found)


def _side_by_side(
    segments: list[bytes], sizes: np.ndarray, owners: np.ndarray, first: np.ndarray, last: np.ndarray
) -> Spans:
    """The same for some problems, given by their first and last segments."""
    counts = last - first
    members = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    size = sizes[members]
    opens = np.zeros(len(members), bool)
    opens[np.cumsum(counts) - counts] = True
    # Symbols: bytes from 1; 0 separates, after every segment and before a problem.
    begin = np.cumsum(size + 1) - size - 1 + np.cumsum(opens)
    total = int(begin[-1] + size[-1] + 1)
    symbols = np.zeros(total, np.int64)
    joined = np.frombuffer(b"".join([segments[m] for m in members]), np.uint8)
    symbols[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(len(joined))] = joined.astype(np.int64) + 1
    bounds = np.append(begin[opens] - 1, total)
    ordered = suffix_arrays(symbols, bounds)
    windows = np.maximum(size - WINDOW + 1, 0)
    segment = np.full(total, -1, np.int64)
    starts = np.repeat(begin - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    segment[starts] = np.repeat(np.arange(len(members)), windows)
    ordered = ordered[segment[ordered] >= 0]
    if not len(ordered):
        return _joined([])
    # Neighbours in the order that begin with the same string form a class.
    place = np.repeat(np.arange(len(bounds) - 1), counts)[segment[ordered]]
    views = np.lib.stride_tricks.sliding_window_view(symbols.astype(np.int16), WINDOW)
    equal = place[1:] == place[:-1]
    for skip in (0, WINDOW - 8):  # A few symbols tell most apart.
        for i in range(skip, skip + 8, 4):
            equal &= symbols[ordered[1:] + i] == symbols[ordered[:-1] + i]
    probe = np.nonzero(equal)[0]
    for i in range(0, len(probe), 1 << 16):
        at = probe[i : i + (1 << 16)]
        equal[at] = (views[ordered[at]] == views[ordered[at + 1]]).all(1)
    fresh = np.nonzero(np.append(True, ~equal))[0]
    who = owners[members[segment[ordered]]]
    least = np.repeat(np.minimum.reduceat(who, fresh), np.diff(np.append(fresh, len(ordered))))
    repeated = np.sort(ordered[least < who])
    if not len(repeated):
        return _joined([])
    inside = segment[repeated]
    new = np.ones(len(repeated), bool)
    new[1:] = (repeated[1:] != repeated[:-1] + 1) | (inside[1:] != inside[:-1])
    new = np.nonzero(new)[0]
    end = repeated[np.append(new[1:], len(repeated)) - 1] + WINDOW
    inside = inside[new]
    return members[inside], repeated[new] - begin[inside], end - begin[inside]


def _distinct(pieces: list[bytes], owners: np.ndarray, problem: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal pieces of a problem as one: number of each, smallest owner, and the problem."""
    seen: dict[tuple[int, bytes], int] = {}
    number = np.array([seen.setdefault(k, len(seen)) for k in zip(problem.tolist(), pieces)], np.int64)
    least = np.full(len(seen), np.iinfo(np.int64).max)
    np.minimum.at(least, number, owners)
    return number, least, np.array([p for p, _ in seen], np.int64)


def _cut_anew(segments: list[bytes], problem: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Segments of crowded problems as pieces with a longer anchor in common.

    The pieces, the segment of each and where in it they start, and their problems.
    """
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in segments], dtype=np.int64)])
    raw = b"".join(segments)
    origin, start, windows, anchor = runs_of(np.frombuffer(raw, np.uint8), bounds, LONG_GRAM)
    order = np.lexsort((anchor, problem[origin]))
    origin, start, windows, anchor = origin[order], start[order], windows[order], anchor[order]
    pieces = [raw[a : a + n] for a, n in zip(start.tolist(), (windows + WINDOW - 1).tolist())]
    old = problem[origin]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (old[1:] != old[:-1])
    return pieces, origin, start - bounds[origin], np.cumsum(new) - 1


def _solved(pieces: list[bytes], owners: np.ndarray, problem: np.ndarray, deep: bool = True) -> Spans:
    """``piece, start, stop`` of what is repeated; ``problem`` counts from 0, in rising order."""
    if not pieces:
        return _joined([])
    number, least, of = _distinct(pieces, owners, problem)
    sizes = np.array([len(p) for p in pieces], np.int64)
    # A piece that a smaller owner has as a whole is repeated as a whole.
    late = np.nonzero(least[number] < owners)[0]
    found = [(late, np.zeros(len(late), np.int64), sizes[late])]
    keepers = np.nonzero(least[number] == owners)[0]
    keepers = keepers[np.argsort(number[keepers], kind="stable")]
    held = np.searchsorted(number[keepers], np.arange(len(least) + 1))
    text = [pieces[i] for i in keepers[held[:-1]].tolist()]
    crowd = np.bincount(of)[of]
    plain = np.nonzero((crowd > 1) & ((crowd <= CROWD) | (not deep)))[0]
    k, start, stop = repeated_spans([text[i] for i in plain], least[plain], of[plain])
    parts = [(plain[k], start, stop)]
    large = np.nonzero(crowd > CROWD)[0] if deep else plain[:0]
    if len(large):
        again, origin, shift, anew = _cut_anew([text[i] for i in large], of[large])
        k, start, stop = _solved(again, least[large][origin], anew, deep=False)
        parts.append((large[origin[k]], start + shift[k], stop + shift[k]))
    k, start, stop = _joined(parts)
    # Every piece that stands for its text has the text's spans.
    copies = held[k + 1] - held[k]
    which = np.repeat(held[k] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
    found.append((keepers[which], np.repeat(start, copies), np.repeat(stop, copies)))
    return _joined(found)


def _repeats(payloads: list[bytes]) -> list[tuple[int, bytes]]:
    """To every group, the spans of its documents that a bucket's segments show repeated."""
    low, owner, mark, offset, home, pieces = [], [], [], [], [], []
    for payload in payloads:
        a, b, c, d, n, h, raw = _unpacked(payload, np.uint32, np.int64, np.int64, np.int64, np.int32, np.int32)
        stops = np.cumsum(n, dtype=np.int64)
        pieces += [raw[j - i : j] for j, i in zip(stops.tolist(), n.tolist())]
        for into, x in zip((low, owner, mark, offset, home), (a, b, c, d, h)):
            into.append(x)
    low, owner, mark, offset, home = (np.concatenate(x) for x in (low, owner, mark, offset, home))
    order = np.argsort(low, kind="stable")
    low, owner, mark, offset, home = low[order], owner[order], mark[order], offset[order], home[order]
    pieces = [pieces[i] for i in order.tolist()]
    problem = np.cumsum(np.diff(low.astype(np.int64), prepend=-1) != 0) - 1
    at, start, stop = _solved(pieces, owner, problem)
    table = np.stack([home[at].astype(np.int64), owner[at], mark[at], offset[at] + start, offset[at] + stop], 1)
    table = table[np.argsort(table[:, 0], kind="stable")]
    return [(g, _packed(*(table[s, c].copy() for c in range(1, 5)))) for g, s in _slices(table[:, 0])]


def _applied(docs: pa.Table, told: pa.Table) -> pa.Table:
    """A group's documents with their spans, and what is left of them."""
    ids, marks = docs.column("id").to_numpy(), docs.column("t").to_numpy()
    data, bounds = _bytes_of(docs.column("data"))
    kinds = (np.int64,) * 4
    parts = [np.stack(_unpacked(p.as_py(), *kinds)[:4], 1) for p in told.column("payload")]
    spans = np.concatenate([np.zeros((0, 4), np.int64), *parts])
    spans = spans[np.lexsort((spans[:, 3], spans[:, 2], spans[:, 1], spans[:, 0]))]
    by: dict[tuple[int, int], slice] = {}
    new = np.nonzero((np.diff(spans[:, :2], axis=0, prepend=spans[:1, :2] - 1) != 0).any(1))[0]
    for a, b in zip(new.tolist(), [*new[1:].tolist(), len(spans)]):
        by[int(spans[a, 0]), int(spans[a, 1])] = slice(a, b)
    removed, kept = [], []
    for i, name in enumerate(zip(ids.tolist(), marks.tolist())):
        raw = data[bounds[i] : bounds[i + 1]].tobytes()
        runs: list[list[int]] = []
        if name in by:
            for a, b in spans[by[name], 2:].tolist():
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
        edges = [0, *(x for run in runs for x in run), len(raw)]
        kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
        removed.append([{"start": a, "stop": b} for a, b in runs])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    columns = [docs.column("id"), pa.array(np.diff(bounds)), pa.array(removed, kind), pa.array(kept, pa.binary())]
    return pa.Table.from_arrays(columns, ["id", "n_bytes", "removed", "kept"])


def _dealt(docs: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """``part, id, t, data``: rows dealt by key and text, so no key or step of keys is crowded."""
    raw = text_or_empty(text)
    # Null keys get the largest number, and their rows are told apart by their text.
    whole = F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1))
    mark = F.xxhash64(raw)
    return docs.select(
        F.pmod(F.xxhash64(whole, mark), F.lit(parts)).cast("int").alias("part"),
        whole.alias("id"),
        mark.alias("t"),
        raw.cast("binary").alias("data"),
    )


def without_seen_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``key, n_bytes, removed, kept`` of every row.

    ``removed`` holds the maximal runs ``start, stop`` of removed bytes, ``kept`` the
    other bytes.  Keys are whole numbers.  Null texts are empty, and texts shorter than a
    window keep all.  A null key comes after all others.  Rows that repeat a key are the
    same document: neither is before the other, and each is judged by its own text.  An
    empty table gives an empty one.  Other columns are not read.
    """
    raw = text_or_empty(text)
    total = docs.agg(F.coalesce(F.sum(F.octet_length(raw).cast("long")), F.lit(0))).first()[0]
    parts = max(1, -(-total // group_bytes))
    rows = _dealt(docs, key, text, parts)

    def announce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield from _announced(batch.slice(at, ROWS), parts, parts)

    def gathered(function, kind: int):
        def run(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
            if key[0] != 0:
                return pd.DataFrame({"part": batch["part"], "payload": batch["payload"]})
            payloads = batch["payload"].tolist()
            found = function(int(key[1]), payloads) if kind == 0 else function(payloads)
            return pd.DataFrame(found, columns=["part", "payload"])

        return run

    def segments(docs: pa.Table, told: pa.Table) -> pa.Table:
        found = list(_segments(docs, told, parts))
        schema = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("payload", pa.binary())])
        return pa.Table.from_arrays([pa.array([r[i] for r in found], schema.field(i).type) for i in range(3)], schema=schema)

    anchors = rows.select("part", "id", "data").mapInArrow(announce, _PARTS)
    told = anchors.groupBy("kind", "part").applyInPandas(gathered(_shared, 0), "part int, payload binary")
    told = stored(told, "suffix-anchors")
    dealt = rows.groupBy("part")
    sent = dealt.cogroup(told.groupBy("part")).applyInArrow(segments, _PARTS)
    spans = sent.groupBy("kind", "part").applyInPandas(gathered(_repeats, 1), "part int, payload binary")
    result = dealt.cogroup(spans.groupBy("part")).applyInArrow(
        _applied, "id long, n_bytes long, removed array<struct<start:long,stop:long>>, kept binary"
    )
    kind = docs.schema[key].dataType
    own = F.when(F.col("id") != (1 << 63) - 1, F.col("id")).cast(kind)
    return result.select(own.alias(key), "n_bytes", "removed", "kept")
