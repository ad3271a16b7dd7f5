"""Samples and splits.

The hash forms depend on the key and the seed alone: the same rows come out
whatever the partitioning, after a retry and on any cluster.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unit_hash(key: Column, seed: int) -> Column:
    """A value in [0, 1) from the first 32 bits of md5(seed:key); NULL is the empty key."""
    name = F.coalesce(key.cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Rows whose key falls into the given fraction; rows without a key go together."""
    return df.where(unit_hash(F.col(key), seed) < F.lit(float(fraction)))


def hash_parts(
    df: DataFrame, key: str, weights: Sequence[float], seed: int, name: str = "part"
) -> DataFrame:
    """Add the number, from 1, of the part each row falls into, by the weights."""
    total = float(sum(weights))
    ends = [end / total for end in accumulate(weights)]
    part = F.lit(len(ends))
    at = F.col("__at")
    for number, end in reversed(list(enumerate(ends[:-1], 1))):
        part = F.when(at < F.lit(end), F.lit(number)).otherwise(part)
    return df.withColumn("__at", unit_hash(F.col(key), seed)).withColumn(name, part).drop("__at")


def hash_split(
    df: DataFrame, key: str, weights: Sequence[float], seed: int
) -> list[DataFrame]:
    """Disjoint parts that cover all rows, in proportion to the weights.

    Each part scans ``df``; persist it, or use ``hash_parts``, where that is costly.
    """
    marked = hash_parts(df, key, weights, seed, "__part")
    return [
        marked.where(F.col("__part") == number).drop("__part")
        for number in range(1, len(weights) + 1)
    ]


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Each row with the given probability, without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_split(
    df: DataFrame, weights: Sequence[float], seed: int
) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def stratified_folds(
    df: DataFrame, key: str, classes: Sequence[str], folds: int, seed: int, stretches: int = 1024
) -> DataFrame:
    """``key`` and ``fold_<class>`` from 0, for each column of ``classes``, once per key.

    Within each value of a class the keys are numbered in hash order and dealt out in
    turn, so every value with at least ``folds`` keys is in every fold and fold sizes
    differ by one at most for a value.  A key with several values counts for the largest;
    NULL is a value, and a key, of its own.

    The numbers come from counts: hashes fall into ``stretches``, and a row's number is
    what the stretches before hold plus its place in its own.  No task sorts a value.
    """
    names = [f"fold_{c}" for c in classes]
    own = df.groupBy(F.col(key).alias("__key")).agg(*(F.max(c).cast("string").alias(c) for c in classes))
    pairs = F.array(*(F.struct(F.lit(n).alias("name"), F.col(c).alias("value")) for n, c in zip(names, classes)))
    rows = own.select("__key", F.inline(pairs)).withColumn("at", unit_hash(F.col("__key"), seed))
    rows = rows.withColumn("stretch", F.floor(F.col("at") * stretches))
    sizes = rows.groupBy("name", "value", "stretch").agg(F.count("*").alias("size"))
    upto = Window.partitionBy("name", "value").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("name").alias("__n"), F.col("value").alias("__v"), F.col("stretch").alias("__s"),
        F.coalesce(F.sum("size").over(upto), F.lit(0)).alias("before"),
    )
    inside = Window.partitionBy("name", "value", "stretch").orderBy("at", "__key")
    ranked = rows.withColumn("place", F.row_number().over(inside) - 1).join(
        sizes,
        (F.col("name") == F.col("__n")) & F.col("value").eqNullSafe(F.col("__v")) & (F.col("stretch") == F.col("__s")),
    )
    fold = ((F.col("before") + F.col("place")) % folds).cast("int")
    return ranked.groupBy(F.col("__key").alias(key)).agg(
        *(F.max(F.when(F.col("name") == n, fold)).alias(n) for n in names)
    )
