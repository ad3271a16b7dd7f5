"""The joins.  All are inner equi-joins, or a left join onto a dimension.

Spark broadcasts a side when its size estimate, or its real size once a shuffle has
run, is under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise; only
the labelled set, once counted, is broadcast by hint, in blocks if need be.  In a sort-merge join, adaptive
execution splits the partition of a hot key over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtone.functions.scalars import submission_id

# Labelled comments that are broadcast: about 100 bytes each.
BROADCAST_LABELS = 1_000_000
# Rows a task takes through the text steps: a few MB of text.
ROWS_PER_TASK = 2048


def labelled_comments(
    labeled: DataFrame,
    comments: DataFrame,
    labels: Sequence[str],
    most: int = BROADCAST_LABELS,
) -> DataFrame:
    """Label columns and body of every labelled comment.

    The labels are counted.  Up to ``most`` rows, an id and a few short values each,
    they are broadcast; beyond that they are cut by hash into blocks of at most ``most``
    rows, which are broadcast one after the other, each with a pass over the comments.
    No body is shuffled.  Only if so many labelled rows are equal in every column that
    no cut parts them, or with ``most`` at 0, both sides are shuffled.
    """
    narrow = labeled.select("Input_id", *labels)
    bodies = comments.select("id", "body")

    def joined(block: DataFrame) -> DataFrame:
        return bodies.join(block, F.col("id") == F.col("Input_id")).select("Input_id", *labels, "body")

    rows = labeled.count()
    if rows <= most:
        return joined(F.broadcast(narrow))
    blocks = _blocks(narrow, -(-rows // most), most) if most > 0 else 0
    if not blocks:
        return joined(narrow.hint("merge"))
    parts = [joined(F.broadcast(narrow.where(_block(narrow, blocks) == i))) for i in range(blocks)]
    return reduce(DataFrame.unionByName, parts)


def _block(rows: DataFrame, blocks: int) -> Column:
    return F.pmod(F.xxhash64(*rows.columns), F.lit(blocks))


def _blocks(rows: DataFrame, least: int, most: int) -> int:
    """How many blocks it takes for none to have over ``most`` rows; 0 if none do."""
    for blocks in (least, -(-least * 5 // 4), 2 * least, 4 * least):
        sizes = rows.groupBy(_block(rows, blocks).alias("block")).count()
        if sizes.agg(F.max("count")).first()[0] <= most:
            return blocks
    return 0


def dealt(df: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` over tasks of ``per_task`` rows at most, or of fewer to use all slots.

    What a join leaves may be little and unevenly spread; and what a task gathers by term
    must not grow with the table.  The rows are counted first, which reads the keys alone.
    """
    rows = df.count()
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(2 * slots, rows // 64), -(-rows // per_task)))


def with_submissions(
    comments: DataFrame, submissions: DataFrame, carry: Sequence[str] = ()
) -> DataFrame:
    """Comment metadata next to the submission the comment belongs to.

    ``carry`` names further comment columns to keep, such as ``body`` or flags.
    """
    left = comments.select(
        F.col("created_utc").alias("timestamp"),
        F.col("score").alias("c_score"),
        submission_id(F.col("link_id")).alias("__link"),
        F.col("author_flair_text").alias("state"),
        F.col("id").alias("comment_id"),
        *carry,
    )
    right = submissions.select(
        F.col("id").alias("link_id"), F.col("score").alias("s_score")
    )
    return left.join(right, F.col("__link") == F.col("link_id")).select(
        "timestamp", "c_score", "s_score", "link_id", "state", "comment_id", *carry
    )


def with_flags(metadata: DataFrame, flags: DataFrame, id_column: str = "id") -> DataFrame:
    """Comment metadata next to flags that were stored apart from it."""
    named = flags.withColumnRenamed(id_column, "__flag_id")
    return metadata.join(named, F.col("comment_id") == F.col("__flag_id")).drop(
        "__flag_id"
    )


def both_probabilities(
    positive: DataFrame, negative: DataFrame, probability: str = "probability"
) -> DataFrame:
    """Outputs of two separately stored models side by side, by ``id``.

    Needed only for outputs stored apart; ``plans.scoring`` gets both in one pass.
    """
    return positive.select("id", F.col(probability).alias("pos_prob")).join(
        negative.select("id", F.col(probability).alias("neg_prob")), "id"
    )


def looked_up(
    dimension: DataFrame,
    facts: DataFrame,
    key: str,
    value: str,
    missing: str = "error",
) -> DataFrame:
    """Every row of a dimension with its fact.

    A key without a fact stops the job (``missing="error"``) or gets NULL
    (``missing="null"``).
    """
    if missing not in ("error", "null"):
        raise ValueError("missing must be 'error' or 'null'")
    found = dimension.join(
        facts.select(key, value, F.lit(True).alias("__found")), key, "left"
    )
    if missing == "error":
        found = found.withColumn(value, _or_raise(F.col(value), F.col(key)))
    return found.drop("__found")


def _or_raise(value: Column, key: Column) -> Column:
    message = F.concat(F.lit("no fact for "), key.cast("string"))
    return F.when(F.col("__found"), value).otherwise(
        F.raise_error(message).cast("double")
    )
