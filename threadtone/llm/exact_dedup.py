"""Exact dedup: one row of each group of equal texts stays.

Rows are grouped by a 128-bit hash of their normalised text; inside groups the bytes
are compared with those of the row that stays, so that a collision of hashes can
neither drop a row nor inflate a group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtone.llm.common import BLANK, marks, one_row_each, stored, text_or_empty


def squeezed(text: Column) -> Column:
    """The text without its blanks."""
    return F.regexp_replace(text, BLANK + "+", "")


def exact_dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] = squeezed,
    digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """A decision for every row: ``key, keep_id, group_size, kept, text_sha256``.

    Of texts that are equal after ``normalise`` the one with the most code points in
    its original form stays, then the one with the smallest key.  Null texts count as
    empty, all empty texts are equal.  A null key comes after all others.  Rows that
    repeat a key and a text get the same decision, as nothing tells them apart.  An
    empty table gives an empty result; other columns are not read.

    Only rows of groups with more than one member take their text to the comparison.
    That join and the one before read stored tables, so a group with a third of all
    rows is split over tasks; the grouping itself sends one row per task and hash.
    """
    rows = docs.select(F.col(key).alias("id"), text_or_empty(text).alias("raw"))
    rows = rows.select("id", F.char_length("raw").alias("n"), normalise(F.col("raw")).alias("norm"))
    rows = rows.select("id", "n", "norm", digest(F.col("norm")).alias("h"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no"), "id"))
    groups = rows.groupBy("h").agg(F.count("*").alias("size"), best.alias("best"))
    groups = stored(
        groups.filter("size > 1").select(
            "h", "size", F.col("best.id").alias("best_id"), (-F.col("best.n")).alias("best_n")
        ),
        "exact-groups",
    )
    # A text goes on only where there is something to compare it with.
    placed = stored(
        rows.join(groups.hint("merge"), "h", "left").select(
            "id", "n", "h", "size", "best_id", "best_n",
            F.sha2("norm", 256).alias("sha"),
            F.when(F.col("size").isNotNull(), F.col("norm")).alias("norm"),
        ),
        "exact-placed",
    )
    single = placed.filter("size is null").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha"
    )
    member = placed.filter("size is not null")
    stays = (F.col("n") == F.col("best_n")) & F.col("id").eqNullSafe(F.col("best_id"))
    texts = stored(
        member.filter(stays).groupBy("h").agg(F.min("norm").alias("best_norm")), "exact-texts"
    )
    same = F.col("norm") == F.col("best_norm")
    compared = stored(
        member.join(texts.hint("merge"), "h").select(
            "id", "n", "h", "size", "best_id", "sha", same.alias("same"),
            F.when(~same, F.col("norm")).alias("other"),
        ),
        "exact-compared",
    )
    proven = compared.select("id", F.col("best_id").alias("keep_id"), F.col("size").alias("group_size"), "sha")
    collided = compared.filter("not same").select("h").distinct()
    if not collided.isEmpty():
        proven = _regrouped(compared, collided)
    return single.unionByName(proven).select(
        F.col("id").alias(key),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _regrouped(compared: DataFrame, collided: DataFrame) -> DataFrame:
    """Decisions where texts share a hash: such hashes are grouped by the bytes."""
    fine = compared.join(collided, "h", "left_anti").select(
        "id", F.col("best_id").alias("keep_id"), F.col("size").alias("group_size"), "sha"
    )
    mixed = compared.join(collided, "h", "left_semi").withColumn(
        "own", F.coalesce("other", F.lit(""))
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no"), "id"))
    classes = stored(
        mixed.groupBy("h", "same", "own").agg(
            F.count("*").alias("group_size"), best["id"].alias("keep_id")
        ),
        "exact-classes",
    )
    mixed = mixed.select("id", "h", "same", "own", "sha").join(classes, ["h", "same", "own"])
    return fine.unionByName(mixed.select("id", "keep_id", "group_size", "sha"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each text, all columns as they were.

    Of several rows with the key that stays the one whose hash is smallest stays, and of
    equal rows any.
    """
    name = F.struct(F.col(key).isNull().alias("no"), F.col(key).alias("id"), *marks(*docs.columns))
    decisions = exact_dedup(docs.select(name.alias("name"), F.col(text).alias("text")), "name", "text")
    kept = decisions.filter("kept").groupBy("name").agg((F.count("*") > 1).alias("again"))
    return one_row_each(docs, kept.select("name.*", "again"), key)
