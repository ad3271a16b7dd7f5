"""What the operators share: reading the given tables, cutting lineage, raw files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadtone.session import fresh_path
from threadtone.sources.filesystem import files

#: The six ASCII blanks that the contracts name, as a pattern.
BLANK = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    The lineage ends at files that every executor sees, so a lost executor costs a
    re-read and no recomputation; joins on what comes back get exchanges of their
    own, which adaptive execution may split.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str | Column) -> Column:
    """A text column with null taken as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """``A`` to ``Z`` in lower case, every other character as it is.

    ``lower`` does the same for pure ASCII and is far cheaper, so it takes those.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(
        F.octet_length(text) == F.char_length(text), F.lower(text)
    ).otherwise(F.translate(text, upper, upper.lower()))


def whole_row(docs: DataFrame) -> Column:
    """All columns as one, so that none can clash with those an operator adds."""
    return F.struct(*(docs[c] for c in docs.columns)).alias("doc")


def marks(*columns: str | Column) -> list[Column]:
    """Two hashes of some columns, ``mark1`` and ``mark2``, 128 bits together."""
    return [F.xxhash64(F.lit(i), *columns).alias(f"mark{i}") for i in (1, 2)]


def _same(docs: DataFrame, named: DataFrame, key: str, columns: Sequence[str]) -> Column:
    own = marks(*(docs[c] for c in columns))
    return docs[key].eqNullSafe(named["__id"]) & (own[0] == named["__mark1"]) & (own[1] == named["__mark2"])


def without(docs: DataFrame, dropped: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The rows of ``docs`` whose key and hashes of ``columns`` are not in ``dropped``.

    ``dropped`` has ``id, mark1, mark2``.  Rows that repeat a key, null too, are told
    apart by the hashes.
    """
    gone = dropped.select("id", "mark1", "mark2").toDF("__id", "__mark1", "__mark2").distinct()
    return docs.join(gone.hint("merge"), _same(docs, gone, key, columns), "left_anti")


def one_row_each(docs: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Exactly one row of ``docs`` for each row of ``kept``: ``id, mark1, mark2, again``.

    The hashes are of all columns.  ``again`` marks those that more than one row of
    ``docs`` has; such rows are equal in every column and become one, each task first
    merging its own.
    """
    named = stored(kept.select("id", "mark1", "mark2", "again"), "rows-kept")

    def found(again: bool) -> DataFrame:
        wanted = named.filter(F.col("again") == again).toDF("__id", "__mark1", "__mark2", "__again")
        return docs.join(wanted.hint("merge"), _same(docs, wanted, key, docs.columns), "left_semi")

    if named.filter("again").isEmpty():
        return found(False)
    return found(False).unionByName(found(True).dropDuplicates())


@contextmanager
def published(folder: str, name: str, attempt: str) -> Iterator[pyarrow.NativeFile]:
    """A file that appears under its name only when it is complete.

    A task that is run again, or twice at once, writes the same bytes under a name of
    its own and moves them over; readers never see half a file.
    """
    system, path = files(folder)
    system.create_dir(path, recursive=True)
    scratch = f"{path}/_{name}.{attempt}"
    with system.open_output_stream(scratch, compression=None) as out:
        yield out
    system.move(scratch, f"{path}/{name}")
