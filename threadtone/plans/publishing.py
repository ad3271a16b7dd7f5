"""Flags to published share tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtone.constants import STATES
from threadtone.functions.scalars import in_states, local_date
from threadtone.operators.share import flags_of, share, share_by_target, unfolded
from threadtone.session import fresh_path
from threadtone.sources.filesystem import remove
from threadtone.sources.writers import published_together, write_csv_files, write_then_read


def share_tables(
    sentiment: DataFrame, targets: Sequence[str], states: Sequence[str] = STATES
) -> dict[str, DataFrame]:
    """Four shares of all targets, each ``target, <key>, Positive, Negative``.

    The score tables count valid states only; the day table counts every row.  The share
    by submission is ``operators.share.share_by_submission``, which sums up before the
    join that gives the submission.
    """
    valid = in_states(F.col("state"), states)

    def by(key: Column | str, name: str, where: Column | None = None) -> DataFrame:
        return share_by_target(sentiment, key, name, targets, where)

    return {
        "day": by(local_date(F.col("timestamp")), "date"),
        "state": by("state", "state", valid),
        "comment_score": by("c_score", "comment_score", valid),
        "submission_score": by("s_score", "submission_score", valid),
    }


# Published file per table, its key, and the names of its shares.
FILES = {
    "day": ("time_data.csv", "date", "pos_avg_day", "neg_avg_day"),
    "state": ("state_data.csv", "state", "Positive", "Negative"),
    "comment_score": ("comment_score.csv", "comment_score", "Positive", "Negative"),
    "submission_score": (
        "submission_score.csv",
        "submission_score",
        "Positive",
        "Negative",
    ),
}


def all_shares(
    sentiment: DataFrame, targets: Sequence[str], states: Sequence[str] = STATES
) -> DataFrame:
    """``table, key`` (as text) and the shares of every published table, in one pass.

    Every row counts towards its day, and with a valid state towards the others too.
    """
    valid = in_states(F.col("state"), states)

    def entry(table: str, key: Column) -> Column:
        return F.struct(F.lit(table).alias("table"), key.cast("string").alias("key"))

    day = entry("day", local_date(F.col("timestamp")))
    rest = [
        entry("state", F.col("state")),
        entry("comment_score", F.col("c_score")),
        entry("submission_score", F.col("s_score")),
    ]
    entries = F.when(valid, F.array(day, *rest)).otherwise(F.array(day))
    rows = sentiment.select(F.inline(entries), *flags_of(targets))
    return share(rows, ["table", "key"], flags_of(targets))


def publish(
    sentiment: DataFrame,
    targets: Sequence[str],
    folder: str,
    states: Sequence[str] = STATES,
    unprefixed: str | None = "djt",
) -> list[str]:
    """Write the four CSV files of each target; returns their paths.

    File names carry the target as prefix, except those of ``unprefixed``.  One pass
    over the rows gives the shares of all tables and targets, which are stored; the
    files of one table come from one job over them.  All files appear together: until
    the last is written, those of an earlier run stay as they are.
    """
    spark = sentiment.sparkSession
    home = fresh_path(spark, "shares")
    shares = write_then_read(all_shares(sentiment, targets, states), home)
    try:
        return published_together(
            spark, folder.rstrip("/"), lambda stage: _write(shares, targets, stage, unprefixed)
        )
    finally:
        remove(spark, home)


def _write(
    shares: DataFrame, targets: Sequence[str], folder: str, unprefixed: str | None
) -> list[str]:
    written = []
    for table, (file, key, positive, negative) in FILES.items():
        paths = {
            t: f"{folder}/{file}" if t == unprefixed else f"{folder}/{t}_{file}"
            for t in targets
        }
        kind = "bigint" if key.endswith("_score") else "string"
        wide = shares.where(F.col("table") == table).withColumn(key, F.col("key").cast(kind))
        rows = unfolded(wide, key, targets).select(
            "target",
            key,
            F.col("Positive").alias(positive),
            F.col("Negative").alias(negative),
        )
        write_csv_files(rows, "target", paths, [key])
        written.extend(paths.values())
    return written
