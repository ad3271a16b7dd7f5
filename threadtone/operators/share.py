"""Share of flagged rows per group.

One partial aggregate per task goes into the shuffle, one row per key, so a key
that holds a third of all rows costs no more than any other.  That holds as long as the
rows are not shuffled by the same key before: right after a join on the key, Spark
aggregates where the join has put the rows.  ``share_by_submission`` therefore
aggregates first and joins the sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtone.functions.scalars import submission_id


def _ratio(flag: str) -> Column:
    return F.sum(flag) / F.count(F.lit(1))


def share(
    df: DataFrame,
    key: Column | str | Sequence[str],
    flags: Mapping[str, str],
    where: Column | None = None,
) -> DataFrame:
    """``sum(flag) / count(*)`` per key; ``flags`` maps output name to flag column."""
    rows = df if where is None else df.where(where)
    keys = list(key) if isinstance(key, (list, tuple)) else [key]
    return rows.groupBy(*keys).agg(
        *[_ratio(flag).alias(name) for name, flag in flags.items()]
    )


def share_by_target(
    df: DataFrame,
    key: Column | str,
    name: str,
    targets: Sequence[str],
    where: Column | None = None,
) -> DataFrame:
    """``target, <name>, Positive, Negative`` from the flags of many targets.

    ``df`` has the columns ``<target>_pos, <target>_neg``.  All targets are
    aggregated in one pass and the small result is unfolded, not the input.
    """
    column = F.col(key) if isinstance(key, str) else key
    return unfolded(share(df, column.alias(name), flags_of(targets), where), name, targets)


def flags_of(targets: Sequence[str]) -> dict[str, str]:
    """The flag columns of all targets, by the names of their shares."""
    return {f"{t}_{kind}": f"{t}_{kind}" for t in targets for kind in ("pos", "neg")}


def share_by_submission(
    comments: DataFrame,
    submissions: DataFrame,
    flags: Mapping[str, str],
    name: str = "link_id",
) -> DataFrame:
    """``name`` and the shares of every submission that has comments.

    ``comments`` has ``link_id`` and the flags.  They are summed up by link before
    the submissions come in, so a submission with a third of all comments reaches the
    join as one row.
    """
    by = comments.groupBy(submission_id(F.col("link_id")).alias(name)).agg(
        *[_ratio(flag).alias(share) for share, flag in flags.items()]
    )
    known = submissions.select(F.col("id").alias("__id"))
    return by.join(known, F.col(name) == F.col("__id"), "left_semi")


def unfolded(wide: DataFrame, name: str, targets: Sequence[str]) -> DataFrame:
    """``target, <name>, Positive, Negative`` from one row with the shares of all targets."""
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("target"),
                F.col(f"{t}_pos").alias("Positive"),
                F.col(f"{t}_neg").alias("Negative"),
            )
            for t in targets
        ]
    )
    return wide.select(name, F.inline(rows)).select(
        "target", name, "Positive", "Negative"
    )
