"""SimHash near-dedup: fingerprints, links within a radius, and their components.

Fingerprints are compared exactly, in tiles: numpy xors whole blocks and counts bits,
and pairs of tiles whose population counts differ by more than the radius are not
opened.  Two fingerprints within the radius agree on at least one of ``radius + 1``
blocks of bits, so only those that share such a block meet in a task.  A block value
that too many share is cut into tiles by population count, and its tile pairs become
tasks of their own.  Copies are one fingerprint, and a task sends on a spanning forest
of what it has linked, never its pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadtone.llm.common import BLANK, marks, one_row_each, stored

WORDS = 3
RADIUS = 3
SEED = 42
#: Fingerprints on one side of a tile, and in a bucket that one task compares whole.
TILE = 1024
BUCKET = 16 * TILE
_BLANK = re.compile(BLANK.encode())


def _word_lists(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, in lists from pieces of about ``size`` bytes."""
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            blank = _BLANK.search(data, end)
            end = blank.start() if blank else len(data)
        yield data[at:end].split()
        at = end


def fingerprint(data: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """A text's 64 bits: each is the majority of that bit over the shingles' hashes."""
    ones, total, kept, fewer = np.zeros(64, np.int64), 0, [], True
    for found in _word_lists(data.lower()):
        found = kept + found
        shingles = zip(*(found[i:] for i in range(words)))
        count = len(found) - words + 1
        if count > 0:
            fewer = False
            hashes = np.fromiter(
                map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(seed)), np.uint64, count
            )
            for at in range(0, count, 4096):
                bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8), bitorder="little")
                ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
            total += count
        kept = found[-(words - 1) :] if words > 1 else []
    if fewer:
        return xxhash.xxh64_intdigest(b" ".join(kept), seed) if kept else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, marked: bool = False
) -> DataFrame:
    """``id, fp`` for every row; null texts have no words, and no words give zero.

    ``marked`` adds ``mark1, mark2``, hashes of the whole row.
    """
    extra = marks(*docs.columns) if marked else []
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("data"), *extra)
    names = ["id", "fp", *rows.columns[2:]]
    schema = f"id {rows.schema['id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in names[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py() or b"", words) for x in batch.column(1)]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), signed, *batch.columns[2:]], names)

    return rows.mapInArrow(run, schema)


class _Forest:
    """Connected sets of indices; the root of a set is its smallest index."""

    def __init__(self, size: int) -> None:
        self.root = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.root[a], self.root[b]
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (self.root != (up := self.root[self.root])).any():
                self.root = up


def linked(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> np.ndarray:
    """A spanning forest, as pairs of fingerprints, of the links in or between sets.

    ``right`` is None for the links inside ``left``.  Both are worked through in tiles
    by population count.
    """
    sides = [left] if right is None else [left, right]
    sides = [s[np.argsort(np.bitwise_count(s), kind="stable")] for s in sides]
    points = np.concatenate(sides)
    counts = np.bitwise_count(points).astype(np.int16)
    forest = _Forest(len(points))
    rows = range(0, len(sides[0]), TILE)
    for a in rows:
        a_end = min(a + TILE, len(sides[0]))
        first = a if right is None else len(sides[0])
        for b in range(first, len(points), TILE):
            b_end = min(b + TILE, len(points))
            if counts[b] - counts[a_end - 1] > radius or counts[a] - counts[b_end - 1] > radius:
                continue
            differ = np.bitwise_count(points[a:a_end, None] ^ points[None, b:b_end])
            i, j = np.nonzero(differ <= radius)
            forest.link(i + a, j + b)
    child = np.nonzero(forest.root != np.arange(len(points)))[0]
    return np.stack([points[child], points[forest.root[child]]], 1)


def _links_of(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Links of the groups ``bucket, i, j`` that arrive one after the other."""
    left_over = None

    def solved(group: pd.DataFrame) -> np.ndarray:
        points, side = group["fp"].to_numpy().view(np.uint64), group["side"].to_numpy()
        other = points[side == 1] if group["i"].iat[0] != group["j"].iat[0] else None
        return linked(points[side == 0], other, radius)

    def frame(found: list[np.ndarray]) -> pd.DataFrame:
        pairs = np.concatenate([np.empty((0, 2), np.uint64), *found]).view(np.int64)
        return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})

    for batch in batches:
        if left_over is not None:
            batch = pd.concat([left_over, batch], ignore_index=True)
        names = batch[["bucket", "i", "j"]].to_numpy()
        starts = np.nonzero((names[1:] != names[:-1]).any(1))[0] + 1
        bounds = [0, *starts.tolist()]
        yield frame([solved(batch.iloc[a:b]) for a, b in zip(bounds, bounds[1:]) if b - a > 1])
        left_over = batch.iloc[bounds[-1] :]
    if left_over is not None and len(left_over) > 1:
        yield frame([solved(left_over)])


def links(points: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``u, v``: spanning forests of the links among the distinct ``fp`` of ``points``."""
    blocks = radius + 1
    width = 64 // blocks
    ends = [(b * width, 64 if b == blocks - 1 else (b + 1) * width) for b in range(blocks)]
    keys = [
        F.struct(
            F.lit(b).alias("b"),
            F.shiftrightunsigned(F.shiftleft("fp", 64 - end), 64 - end + start).alias("value"),
        )
        for b, (start, end) in enumerate(ends)
    ]
    spread = points.select("fp", F.explode(F.array(*keys)).alias("k")).select(
        "fp", F.xxhash64("k.b", "k.value").alias("bucket")
    )
    sizes = spread.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    sizes = stored(sizes, "simhash-sizes")
    spread = spread.join(sizes.hint("merge"), "bucket").withColumn("cut", F.ceil(F.col("m") / bucket))
    whole = spread.filter("cut = 1").select(
        "bucket", F.lit(-1).cast("long").alias("i"), F.lit(-1).cast("long").alias("j"),
        F.lit(0).alias("side"), "fp",
    )
    # A tile of a crowded bucket: one population count, and a part of those that have it.
    tile = F.bit_count("fp") * F.col("cut") + F.pmod(F.xxhash64("fp"), F.col("cut"))
    near = F.sequence(
        (F.bit_count("fp") - radius) * F.col("cut"), (F.bit_count("fp") + radius + 1) * F.col("cut") - 1
    )
    crowded = spread.filter("cut > 1").select("bucket", "fp", tile.alias("own"), F.explode(near).alias("other"))
    crowded = crowded.select(
        "bucket",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
        "fp",
    )
    # A number of its own: the rows are few for the work they are.
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = whole.unionByName(crowded).repartition(tasks, "bucket", "i", "j")
    dealt = dealt.sortWithinPartitions("bucket", "i", "j")
    return dealt.mapInPandas(partial(_links_of, radius=radius), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, root`` for every node of ``edges`` (``u, v``); the root is the smallest node.

    Large-star and small-star rounds: each hangs a node's neighbours under the
    smallest it knows, until every component is a star.
    """
    edges = stored(edges.filter("u != v").select("u", "v"), "links")

    def lowest(pairs: DataFrame) -> DataFrame:
        return stored(pairs.groupBy("u").agg(F.min("v").alias("m")), "links-lowest")

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = None
    while (now := mark(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = lowest(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(least.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = stored(large.distinct(), "links-large")
        least = lowest(down)
        small = down.join(least.hint("merge"), "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "links-small")
    return edges.select("u", F.col("v").alias("root"))


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    radius: int = RADIUS,
    bucket: int = BUCKET,
) -> DataFrame:
    """``key, fp, component_id`` for every row.

    ``component_id`` is the smallest key that links of at most ``radius`` differing
    bits lead to, the row's own included.  Null and empty texts have the fingerprint
    zero and are linked like any other.  Null keys never name a component unless all
    of its keys are null.  Repeated rows get equal results; an empty table gives an
    empty one; other columns are not read.
    """
    prints = stored(fingerprints(docs, key, text, words), "simhash-prints")
    points = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-points")
    placed = _rooted(points, radius, bucket)
    smallest = stored(placed.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-smallest")
    named = stored(placed.join(smallest.hint("merge"), "root").select("fp", "component_id"), "simhash-named")
    return prints.join(named.hint("merge"), "fp").select(F.col("id").alias(key), "fp", "component_id")


def _rooted(points: DataFrame, radius: int, bucket: int) -> DataFrame:
    """``fp, first, root`` of distinct fingerprints: the smallest of their component."""
    roots = components(links(points.select("fp"), radius, bucket))
    placed = points.join(roots.hint("merge"), F.col("fp") == F.col("u"), "left")
    return stored(placed.select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-placed")


def one_of_each(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    radius: int = RADIUS,
    bucket: int = BUCKET,
) -> DataFrame:
    """One row of ``docs`` for each component, all columns as they were.

    It is a row with the smallest key, null keys last; of several with that key the one
    whose hash is smallest, and of equal rows any.  No component is left without a row.
    """
    prints = stored(fingerprints(docs, key, text, words, marked=True), "simhash-prints")
    rows = prints.groupBy("fp", "id", "mark1", "mark2").agg((F.count("*") > 1).alias("again"))
    first = F.struct(F.col("id").isNull().alias("no"), "id", "mark1", "mark2", "again")
    points = stored(rows.groupBy("fp").agg(F.min(first).alias("first")), "simhash-points")
    best = _rooted(points, radius, bucket).groupBy("root").agg(F.min("first").alias("first"))
    return one_row_each(docs, best.select("first.*"), key)
