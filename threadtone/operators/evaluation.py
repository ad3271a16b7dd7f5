"""Area under ROC as a relational operator, over scores that are stored anywhere."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadtone.session import fresh_path
from threadtone.sources.writers import write_then_read

_EXACT = "decimal(19,0)"


def area_under_roc(
    scored: DataFrame, score: str, label: str, by: Sequence[str] = ()
) -> DataFrame:
    """``by``, ``positives``, ``negatives`` and ``auc`` for each value of ``by``.

    The chance that a positive row (label 1) scores above a negative one, ties counting
    half.  Rows without score or label are left out; NaN is above every number.  Where a
    group has no positive or no negative row, the area is NULL.

    Equal scores are summed up first.  The sums are dealt out in score order, so a task
    adds up the negatives below within its own stretch, and what lies below a stretch
    comes from one row per stretch: no task sees all scores.
    """
    rows = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    positive = F.when(F.col(label) == 1, 1).otherwise(0)
    groups = [f"__by{i}" for i in range(len(by))]
    counts = rows.groupBy(
        *(F.col(c).alias(g) for c, g in zip(by, groups)), F.col(score).cast("double").alias("value")
    ).agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    dealt = counts.repartitionByRange(*groups, "value").withColumn("stretch", F.spark_partition_id())
    dealt = write_then_read(dealt, fresh_path(scored.sparkSession, "auc-values"))

    before = Window.partitionBy(*groups).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = dealt.groupBy("stretch", *groups).agg(F.sum("neg").alias("all"))
    stretches = stretches.withColumn("below", F.coalesce(F.sum("all").over(before), F.lit(0)))
    inside = Window.partitionBy("stretch", *groups).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn("lower", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    named = stretches.select(F.col("stretch").alias("__s"), *(F.col(g).alias(f"{g}s") for g in groups), "below")
    same: list[Column] = [F.col("stretch") == F.col("__s")]
    same += [F.col(g).eqNullSafe(F.col(f"{g}s")) for g in groups]
    ranked = ranked.join(named, reduce(lambda a, b: a & b, same))
    # Twice the pairs in order, whole numbers throughout.
    won = F.col("pos").cast(_EXACT) * (2 * (F.col("below") + F.col("lower")) + F.col("neg")).cast(_EXACT)
    sums = ranked.groupBy(*groups).agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), F.sum(won).alias("won")
    )
    pairs = 2 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return sums.select(
        *(F.col(g).alias(c) for c, g in zip(by, groups)),
        "positives",
        "negatives",
        (F.col("won").cast("double") / F.nullif(pairs, F.lit(0.0))).alias("auc"),
    )
