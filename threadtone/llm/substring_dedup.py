"""Substring dedup: units of text that occur before are cut out.

Units (sentences, lines or paragraphs) are normalised and hashed to 128 bits.  Digests
are grouped over all documents, the occurrence with the smallest rank, key and then
offset, stays.  The others are repeats; runs of neighbouring repeats that are long enough
are removed, so short units go with the passage they are part of and stay where they are
common phrases.  The offsets of what is removed, in the original, are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from threadtone.llm.common import stored, text_or_empty, whole_row

#: Each pattern cuts a text into units that together are the whole text.  Passages are
#: often set into the middle of a line, so sentences are what finds them.
UNITS = {
    "sentence": r"[^.!?\n]+[.!?\n]*|[.!?\n]+",
    "line": r"[^\n]+\n*|\n+",
    "paragraph": r"(?:[^\n]+\n?)+\n*|\n+",
}
#: Normalised bytes from which a run of repeated units is removed.
MIN_BYTES = 150


def units(docs: DataFrame, key: str, text: str, unit: str = "sentence") -> DataFrame:
    """``id, t, start, stop, bytes, h1, h2`` of every unit; ``t`` marks the text.

    ``bytes`` is the normalised unit's length.
    """
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text_or_empty(text)).alias("t"), text_or_empty(text).alias("x"))
    kind = rows.schema["id"].dataType.simpleString()
    pattern = UNITS[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(pattern).findall
        for batch in batches:
            row, size, normal, digests = [], [], [], []

            def out() -> pa.RecordBatch:
                stops, at = np.array(size, np.int64), np.array(row, np.int64)
                total = np.cumsum(stops)
                first = np.nonzero(np.diff(at, prepend=-1))[0]
                base = np.repeat((total - stops)[first], np.diff(first, append=len(at)))
                both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                columns = [
                    batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)),
                    pa.array(total - stops - base), pa.array(total - base),
                    pa.array(np.array(normal, np.int32)), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()),
                ]
                return pa.RecordBatch.from_arrays(columns, ["id", "t", "start", "stop", "bytes", "h1", "h2"])

            for i, value in enumerate(batch.column(2)):
                for piece in find(value.as_py()):
                    norm = b" ".join(piece.encode().lower().split())
                    row.append(i)
                    size.append(len(piece))
                    normal.append(len(norm))
                    digests.append(xxhash.xxh3_128_digest(norm))
                if len(row) > 200_000:
                    yield out()
                    row, size, normal, digests = [], [], [], []
            if row:
                yield out()

    return rows.mapInArrow(run, f"id {kind}, t long, start long, stop long, bytes int, h1 long, h2 long")


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "sentence", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``id, t, start, stop`` of the units to be removed, with ``first_id, first_start``.

    The last two say where the unit occurs first; that occurrence is never removed.
    """
    found = stored(units(docs, key, text, unit), "repeat-units")
    rank = F.struct(F.col("id").isNull().alias("no"), "id", "start", "t")
    first = found.groupBy("h1", "h2").agg(F.count("*").alias("m"), F.min(rank).alias("first"))
    first = first.filter("m > 1").select(
        "h1", "h2", F.col("first.id").alias("first_id"), F.col("first.start").alias("first_start"), F.col("first.t").alias("first_t")
    )
    first = stored(first, "repeat-first")
    again = found.join(first.hint("merge"), ["h1", "h2"]).filter(
        ~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("start") == F.col("first_start")) & (F.col("t") == F.col("first_t")))
    )
    again = stored(again.select("id", "t", "start", "stop", "bytes", "first_id", "first_start"), "repeat-again")
    # Rows that repeat a key and a text become one before their units are put in order.
    along = Window.partitionBy("id", "t").orderBy("start")
    apart = F.coalesce(F.lag("stop").over(along) != F.col("start"), F.lit(True))
    runs = again.distinct().withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(along))
    total = F.sum("bytes").over(Window.partitionBy("id", "t", "run"))
    return runs.withColumn("total", total).filter(F.col("total") >= min_bytes).drop("bytes", "apart", "run", "total")


@F.pandas_udf(StringType())
def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without their spans, which are sorted and apart."""

    def rest(value: str, removed) -> str:
        if removed is None or not len(removed):
            return value
        parts, at = [], 0
        for span in removed:
            parts.append(value[at : span["start"]])
            at = span["stop"]
        return "".join([*parts, value[at:]])

    return pd.Series([rest(v, s) for v, s in zip(text, spans)], dtype=object)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "sentence", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``docs`` with repeated units cut from the text, and ``n_units, removed`` added.

    ``removed`` holds ``start, stop`` of what was cut, in characters of the original.
    Units equal in ASCII lower case and up to blanks are repeats, all but the first.  What
    goes are runs of neighbouring repeats with ``min_bytes`` bytes together, blanks squeezed;
    0 removes every repeat.  Repeats inside one document count too.  Null and empty
    texts have no units and stay as they are.  Rows that repeat a key and a text count as
    one document; null keys rank last.  Other columns go along.  An empty table gives an
    empty one.

    A unit that a third of all documents share is counted by partial aggregates, and the
    join that finds its occurrences reads stored tables, so it is split over tasks.
    """
    again = repeats(docs, key, text, unit, min_bytes)
    spans = again.groupBy("id", "t").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("removed")
    )
    what = stored(spans, "repeat-spans").alias("s")
    rows = docs.select(
        whole_row(docs), F.col(key).alias("id"), F.col(text).alias("x"), F.xxhash64(text_or_empty(text)).alias("t")
    ).alias("d")
    same = F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.t") == F.col("s.t"))
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    rows = rows.join(what.hint("merge"), same, "left").select(
        "doc",
        F.when(F.col("removed").isNotNull(), _cut(text_or_empty("x"), F.col("removed"))).otherwise(F.col("x")).alias("x"),
        F.regexp_count(text_or_empty("x"), F.lit(UNITS[unit])).cast("long").alias("n"),
        F.coalesce("removed", none).alias("removed"),
    )
    own = [F.col("x").alias(c) if c == text else F.col("doc").getField(c).alias(c) for c in docs.columns]
    return rows.select(*own, F.col("n").alias("n_units"), F.col("removed"))
