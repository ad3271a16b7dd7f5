"""Vector code compression: product codes by rounds of integer k-means with adaptive bounds.

A vector is cut into parts and each part gets the number of the nearest entry of its
codebook.  Between rounds every part keeps, in the stored table, its b closest entries
in order, a lower bound on the distance to each of them and one outer bound for all
other entries.  When the codebook moves, bounds shrink by the movements; a part whose
own entry is surely nearer than every bound is left alone, one that is uncertain compares
as many of its list as the ordered bounds demand, and only one whose outer bound fails
meets the whole codebook.  A block of rows shortens its lists to what it has needed, and
starts over with longer ones when the outer bound fails often.  Bounds are floats rounded
to the safe side; whatever they do not decide is decided by exact integer distances.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadtone.llm.common import stored
from threadtone.session import fresh_path
from threadtone.sources.filesystem import remove

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Components are multiplied by this and floored.
SCALE = 256
#: Components beyond are taken as this much: twice of it squared and summed fits 64 bits.
FARTHEST = 1 << 26
#: Listed entries at the start, at least and at most.
START, LEAST, MOST = 8, 2, 16
#: A list must be long enough for this share of a block; beyond the other share of
#: failed outer bounds the block's lists are made anew, twice as long.
ENOUGH, TOO_OFTEN = 0.99, 0.25
#: Rows that are worked on at once.
BLOCK = 1024


def _down(values: np.ndarray) -> np.ndarray:
    """Single-precision numbers that are not larger."""
    return np.nextafter(values.astype(np.float32), np.float32(-np.inf))


def _up(values: np.ndarray) -> np.ndarray:
    return np.nextafter(values, np.inf)


def all_distances(parts: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Squared distances ``(rows, parts, entries)`` of ``(rows, parts, width)`` parts."""
    found = np.empty((*parts.shape[:2], books.shape[1]), np.int64)
    for p in range(parts.shape[1]):
        found[:, p] = ((parts[:, p, None, :] - books[p][None]) ** 2).sum(-1)
    return found


@dataclass
class Lists:
    """Of every part: ``near`` entries, nearest first, bounds for all but the first, and
    the ``outer`` bound; shapes ``(rows, parts, b)``, ``(.., b - 1)``, ``(rows, parts)``."""

    near: np.ndarray
    lower: np.ndarray
    outer: np.ndarray

    def cut(self, b: int) -> Lists:
        """Shorter lists; the first bound that falls off becomes the outer one."""
        if b >= self.near.shape[-1]:
            return self
        fallen = np.minimum(self.lower[..., b - 1 :].min(-1), self.outer)
        return Lists(self.near[..., :b], self.lower[..., : b - 1], fallen)


def _listed(squares: np.ndarray, b: int) -> tuple[Lists, np.ndarray]:
    """Lists out of all squared distances (last axis), and the smallest of them."""
    order = np.argsort(squares, axis=-1, kind="stable")  # equals: lower number first
    b = min(b, squares.shape[-1])
    roots = _down(np.sqrt(np.take_along_axis(squares, order[..., : b + 1], -1)))
    outer = roots[..., b] if b < squares.shape[-1] else np.full(roots.shape[:-1], np.inf, np.float32)
    best = np.take_along_axis(squares, order[..., :1], -1)[..., 0]
    return Lists(order[..., :b].astype(np.uint8), roots[..., 1:b], outer), best


def assign_all(parts: np.ndarray, books: np.ndarray, b: int = START) -> tuple[Lists, np.ndarray]:
    """Every part against its whole codebook: lists, and squared distances to the nearest."""
    return _listed(all_distances(parts, books), b)


def reassign(
    parts: np.ndarray, books: np.ndarray, moves: np.ndarray, lists: Lists
) -> tuple[Lists, np.ndarray, np.ndarray]:
    """Lists after the entries went ``moves`` far, squared distances, and compared depths.

    A depth is how many bounds were not clear of the part's own entry; equal to the
    list's length it means that the whole codebook was compared.
    """
    at = np.arange(parts.shape[1])[None, :, None]
    b = lists.near.shape[-1]
    lower = _down(lists.lower - moves[at, lists.near[..., 1:]])
    outer = _down(lists.outer - moves.max(1)[None, :])
    bounds = np.concatenate([lower, outer[..., None]], -1)
    bounds = np.minimum.accumulate(bounds[..., ::-1], -1)[..., ::-1]
    best = ((parts - books[at[..., 0], lists.near[..., 0]]) ** 2).sum(-1)
    depth = (bounds <= _up(np.sqrt(best))[..., None]).sum(-1)
    near, lower, outer = lists.near.copy(), bounds[..., :-1].copy(), bounds[..., -1].copy()

    i, p = np.nonzero((depth > 0) & (depth < b))
    if len(i):
        seen = np.arange(b)[None] <= depth[i, p][:, None]
        some = near[i, p]
        squares = ((parts[i, p][:, None] - books[p[:, None], some]) ** 2).sum(-1)
        squares[~seen] = np.iinfo(np.int64).max
        order = np.lexsort((np.where(seen, some, 64 + np.arange(b)[None]), squares), axis=-1)
        near[i, p] = np.take_along_axis(some, order, -1)
        exact = _down(np.sqrt(np.take_along_axis(squares, order, -1)[:, 1:]))
        lower[i, p] = np.where(seen[:, 1:], exact, lower[i, p])
        best[i, p] = squares.min(-1)

    i, p = np.nonzero(depth == b)
    if len(i):
        squares = ((parts[i, p][:, None] - books[p]) ** 2).sum(-1)
        anew, best[i, p] = _listed(squares, b)
        near[i, p], lower[i, p], outer[i, p] = anew.near, anew.lower, anew.outer
    return Lists(near, lower, outer), best, depth


def adapted(
    parts: np.ndarray, books: np.ndarray, lists: Lists, depth: np.ndarray
) -> Lists:
    """Lists of the length that this block's depths ask for."""
    b = lists.near.shape[-1]
    if (depth == b).mean() > TOO_OFTEN and b < min(MOST, books.shape[1]):
        return assign_all(parts, books, min(2 * b, MOST))[0]
    reached = np.cumsum(np.bincount(depth.ravel(), minlength=b + 1)) / depth.size
    return lists.cut(max(LEAST, int(np.argmax(reached >= ENOUGH)) + 1))


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Blocks of rows whose lists are equally long."""
    for at in range(0, len(batch), BLOCK):
        block = batch.slice(at, BLOCK)
        if "near" not in batch.schema.names:
            yield block
            continue
        lengths = block.column("near").value_lengths().to_numpy()
        for length in np.unique(lengths):
            yield block.filter(pa.array(lengths == length))


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False)


def _parts_of(block: pa.RecordBatch, shape: tuple[int, int, int]) -> np.ndarray:
    """The block's vectors in parts; the last part is filled up with zeros."""
    parts, _, width = shape
    values = _numbers(block, "parts").astype(np.int64).reshape(len(block), -1)
    filled = np.pad(values, ((0, 0), (0, parts * width - values.shape[1])))
    return filled.reshape(len(block), parts, width)


def _arrays(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    flat = values.reshape(len(values), -1)
    offsets = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel(), kind))


def _state_of(block: pa.RecordBatch, parts: int) -> Lists:
    n = len(block)
    near = _numbers(block, "near").view(np.uint8).reshape(n, parts, -1)
    return Lists(
        near,
        _numbers(block, "lower").astype(np.float32).reshape(n, parts, near.shape[-1] - 1),
        _numbers(block, "outer").astype(np.float32).reshape(n, parts),
    )


def _assigned(
    batches: Iterator[pa.RecordBatch], books: np.ndarray, moves: np.ndarray | None, last: bool
) -> Iterator[pa.RecordBatch]:
    shape = books.shape[0], books.shape[1], books.shape[2]
    for batch in batches:
        for block in _blocks(batch):
            parts = _parts_of(block, shape)
            if moves is None:
                lists, best = assign_all(parts, books)
            else:
                lists, best, depth = reassign(parts, books, moves, _state_of(block, shape[0]))
            given = [block.column("id"), block.column("label")]
            if last:
                codes = pa.array([c.tobytes() for c in lists.near[..., 0]], pa.binary())
                yield pa.RecordBatch.from_arrays([*given, codes, pa.array(best.sum(1))], ["id", "label", "code", "error"])
                continue
            if moves is not None:
                lists = adapted(parts, books, lists, depth)
            state = [
                _arrays(lists.near.view(np.int8), pa.int8()),
                _arrays(lists.lower, pa.float32()),
                _arrays(lists.outer, pa.float32()),
            ]
            yield pa.RecordBatch.from_arrays([*given, block.column("parts"), *state], ["id", "label", "parts", "near", "lower", "outer"])


def _summed(batches: Iterator[pa.RecordBatch], shape: tuple[int, int, int]) -> Iterator[pa.RecordBatch]:
    """Sums and counts of the parts of every entry, once for the whole task."""
    parts, entries, width = shape
    totals = np.zeros((parts * entries, width + 1), np.int64)
    for batch in batches:
        for block in _blocks(batch):
            own = _state_of(block, parts).near[..., 0] + entries * np.arange(parts)[None]
            ones = np.ones((len(block), parts, 1), np.int64)
            rows = np.concatenate([_parts_of(block, shape), ones], -1)
            np.add.at(totals, own.ravel(), rows.reshape(-1, width + 1))
    slots = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(totals.ravel()[slots])], ["slot", "total"])


def moved(books: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries at their parts' floored means, unused ones as they were; how far they went."""
    counts = totals[..., -1:]
    means = np.where(counts > 0, totals[..., :-1] // np.maximum(counts, 1), books)
    return means, _up(np.sqrt(((means - books) ** 2).sum(-1)))


@dataclass
class Coded:
    """``rows``: ``id, label, code`` (a byte for each part) and ``error``; the codebooks."""

    rows: DataFrame
    books: np.ndarray


def product_codes(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Coded:
    """Codes and squared errors of every kept row, and the codebooks behind them.

    Dropped are rows whose vector is null or holds a null, NaN or infinite component,
    and rows whose vector is not as long as that of the smallest kept key; a codebook
    has no place for them.  Codebooks start from the smallest keys (null keys last, equal
    keys in order of their vectors); with fewer rows than ``entries`` they are smaller.
    Lengths that are no multiple of ``parts`` are filled up with zeros.  Components
    beyond ``FARTHEST`` after scaling are taken as that.  Repeated rows are coded alike;
    an empty table gives an empty one and codebooks without entries.

    What reaches the driver is one number for every component of the codebooks.  Each
    round stores the rows with their lists and deletes the table of the round before.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is a byte: 1 to 256 entries")
    spark = vectors.sparkSession
    raw = F.col(vector)
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    limit = F.lit(float(FARTHEST))
    whole = F.transform(
        raw, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, limit), -limit)).cast("int")
    )
    rows = vectors.where(raw.isNotNull() & finite).select(
        F.col(key).alias("id"), F.col(label).alias("label"), whole.alias("parts")
    )
    rows = stored(rows, "codes-parts")
    order = [F.col("id").asc_nulls_last(), "parts"]
    first = rows.orderBy(*order).limit(1).collect()
    length = len(first[0].parts) if first else 0
    rows = rows.where(F.size("parts") == length)
    start = [r.parts for r in rows.orderBy(*order).select("parts").limit(entries).collect()]
    width = -(-length // parts)
    books = np.zeros((len(start), parts * width), np.int64)
    books[:, :length] = np.array(start, np.int64).reshape(len(start), length)
    books = books.reshape(len(start), parts, width).transpose(1, 0, 2).copy()

    head = "".join(f"{n} {rows.schema[n].dataType.simpleString()}, " for n in ("id", "label"))
    states = head + "parts array<int>, near array<tinyint>, lower array<float>, outer array<float>"
    moves, before = None, None
    for _ in range(rounds if start else 0):
        path = fresh_path(spark, "codes-lists")
        step = partial(_assigned, books=books, moves=moves, last=False)
        rows.mapInArrow(step, states).write.parquet(path)
        rows = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
        sums = rows.select("parts", "near", "lower", "outer").mapInArrow(
            partial(_summed, shape=books.shape), "slot long, total long"
        )
        totals = np.zeros((parts, len(start), width + 1), np.int64)
        for slot, total in sums.groupBy("slot").agg(F.sum("total")).collect():
            totals.reshape(-1)[slot] = total
        books, moves = moved(books, totals)
    step = partial(_assigned, books=books, moves=moves, last=True)
    done = stored(rows.mapInArrow(step, head + "code binary, error long"), "codes") if start else rows.select(
        "id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")
    )
    if before:
        remove(spark, before)
    return Coded(done, books)


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the sum over equal labels, nulls together.

    Sums come before the join, whose hot labels adaptive execution may split; a sum that
    does not fit 64 bits is null.
    """
    sums = coded.groupBy(F.col("label").alias("__label")).agg(F.try_sum("error").alias("label_error"))
    sums = stored(sums, "codes-errors")
    joined = coded.join(sums.hint("merge"), coded["label"].eqNullSafe(sums["__label"]))
    return joined.drop("__label")
