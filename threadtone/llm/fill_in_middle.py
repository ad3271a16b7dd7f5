"""Fill-in-middle: a text's lines cut at two ranks, middle and suffix swapped behind markers.

The cuts are ranks of lines, drawn from a hash of the key; where they lie in the text is
found in an indexable skip list.  A node of an express lane carries two widths: how many
lines and how many code points it spans.  A descent adds up line widths until the rank is
reached exactly, and the code-point widths it has passed are the place to cut.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtone.llm.common import text_or_empty

SEED = 7
#: Percent of the texts that are cut, and percent of those whose suffix comes first.
RATE, SPM = 100, 50
#: Fixed values of the format: they stand before the prefix, the suffix and the middle.
MARKERS = ("<P>", "<S>", "<M>")
#: One node in so many rises to the next lane.
STRIDE = 4


def line_widths(text: str) -> np.ndarray:
    """Code points of each line, its line end included; the last may lack one."""
    data = np.frombuffer(text.encode(), np.uint8)
    starts = np.concatenate([[0], np.flatnonzero(data == 10) + 1])
    if starts[-1] == len(data):
        starts = starts[:-1]
    if not len(starts):
        return np.zeros(0, np.int64)
    return np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64)


class SkipList:
    """Lines in order, with lanes above them to reach any rank in a few steps.

    Which nodes rise is decided by a hash of their rank, so equal texts get equal lanes.
    A lane takes two numbers a node and a lane has a quarter of the nodes below it.
    """

    def __init__(self, widths: np.ndarray, stride: int = STRIDE) -> None:
        units, points = np.ones(len(widths), np.int64), widths
        ranks = np.arange(len(widths), dtype=np.uint64)
        #: From the lines upwards: lines and code points spanned, place in the lane below.
        self.lanes = [(units, points, None)]
        while len(units) > stride:
            ranks = (ranks ^ (ranks >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            risen = (ranks >> np.uint64(32)) % np.uint64(stride) == 0
            risen[0] = True
            places = np.flatnonzero(risen)
            units, points = np.add.reduceat(units, places), np.add.reduceat(points, places)
            ranks = ranks[places]
            self.lanes.append((units, points, places))

    def seek(self, rank: int) -> int:
        """The code points in the first ``rank`` lines."""
        at = lines = passed = 0
        for level in range(len(self.lanes) - 1, -1, -1):
            units, points, places = self.lanes[level]
            while at < len(units) and lines + units[at] <= rank:
                lines += int(units[at])
                passed += int(points[at])
                at += 1
            if places is not None:
                at = int(places[at]) if at < len(places) else len(self.lanes[level - 1][0])
        return passed


def draws(name: str, seed: int = SEED) -> list[int]:
    """Four numbers below 2**32 from the seed and a key as text."""
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(
    text: str, name: str, seed: int = SEED, rate: int = RATE, spm: int = SPM,
    markers: tuple[str, str, str] = MARKERS,
) -> tuple[int, str, int | None, int | None, str]:
    """Number of lines, form, code points of prefix and middle, and the new text."""
    widths = line_widths(text)
    n = len(widths)
    first, second, chosen, order = draws(name, seed)
    if not text or chosen % 100 >= rate or any(m in text for m in markers):
        return n, "plain", None, None, text
    low, high = sorted((first % (n + 1), second % (n + 1)))
    lines = SkipList(widths)
    start, end = lines.seek(low), lines.seek(high)
    before, after, between = markers
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if order % 100 < spm:
        return n, "spm", start, end - start, f"{after}{suffix}{before}{prefix}{between}{middle}"
    return n, "psm", start, end - start, f"{before}{prefix}{after}{suffix}{between}{middle}"


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED,
    rate: int = RATE, spm: int = SPM, markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """``key, n, form, prefix_chars, middle_chars, output`` of every row.

    ``form`` is ``psm``, ``spm`` or ``plain``.  Plain are empty and null texts, texts
    that hold a marker, and those the rate leaves alone; they come out as they are, null
    as the empty text, and their widths are null.  A null key draws like the empty key.
    Rows of one key and text get equal results.  Very long texts are cut whole; a task
    holds one batch of rows and some bytes per character of one text.  Other columns are
    not read; an empty table gives an empty one.
    """
    if any(a in b for a in markers for b in markers if a is not b) or any(
        a[:i] == b[-i:] for a in markers for b in markers for i in range(1, min(len(a), len(b)))
    ):
        raise ValueError("markers must not overlap each other or themselves")
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), name.alias("name"), text_or_empty(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    cut = partial(transformed, seed=seed, rate=rate, spm=spm, markers=markers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                found = [cut(t.as_py(), k.as_py()) for k, t in zip(part.column(1), part.column(2))]
                arrays = [pa.array(x, k) for x, k in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names)

    schema = f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", key)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text a row was made from, out of its output and form alone.

    The text holds no marker and markers do not overlap, so each is found once.
    """
    parts = F.split(output, "|".join(re.escape(m) for m in markers), 4)
    at = [F.get(parts, F.lit(i)) for i in range(4)]
    return (
        F.when(form == "psm", F.concat(at[1], at[3], at[2]))
        .when(form == "spm", F.concat(at[2], at[3], at[1]))
        .otherwise(output)
    )
