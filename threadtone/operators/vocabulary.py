"""Vocabulary and binary bag of words."""

from __future__ import annotations

import logging

from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadtone.constants import MIN_DOCUMENT_FREQUENCY, VOCABULARY_SIZE

BROADCAST_CHARACTERS = 1 << 25


def term_statistics(
    df: DataFrame, grams: str = "grams", min_df: int = MIN_DOCUMENT_FREQUENCY
) -> DataFrame:
    """``term, document_frequency, total_count`` of terms in at least ``min_df`` texts.

    Each text's grams are sorted and zipped with themselves shifted by one, so a
    repeat stands next to its original: one pass over the grams and one shuffle
    yield both counts, without a lambda per gram.
    """
    ordered = df.select(F.sort_array(F.col(grams)).alias("term"))
    shifted = F.concat(F.array(F.lit(None).cast("string")), F.col("term"))
    pairs = ordered.withColumn("before", shifted).select(
        F.inline(F.arrays_zip("term", "before"))
    )
    repeat = F.col("term") == F.col("before")
    return (
        pairs.where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(
            F.sum(F.when(repeat, 0).otherwise(1)).alias("document_frequency"),
            F.count(F.lit(1)).alias("total_count"),
        )
        .where(F.col("document_frequency") >= min_df)
    )


def most_frequent(stats: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """The ``size`` terms with the largest total count; equals in term order.

    A histogram with sixteen classes per doubling of the count, so of a thousand rows
    at most, shows the class in which ``size`` terms are reached; only terms of that
    class and above are sorted.
    """
    kind = F.floor(F.log2(F.col("total_count")) * 16).cast("int")
    classes = stats.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("terms"))
    zero = F.struct(F.lit(0).cast("long").alias("terms"), F.lit(0).alias("kind"))
    downwards = F.aggregate(
        F.array_sort(
            F.collect_list(F.struct((-F.col("kind")).alias("down"), "terms"))
        ),
        zero,
        lambda seen, one: F.when(seen["terms"] >= size, seen).otherwise(
            F.struct(
                (seen["terms"] + one["terms"]).alias("terms"),
                (-one["down"]).alias("kind"),
            )
        ),
    )
    level = classes.agg(downwards["kind"].alias("level"))
    return (
        stats.where(kind >= level.scalar())
        .orderBy(F.desc("total_count"), "term")
        .limit(size)
    )


def fit_vocabulary(
    df: DataFrame,
    grams: str = "grams",
    output: str = "vectorized",
    min_df: int = MIN_DOCUMENT_FREQUENCY,
    size: int = VOCABULARY_SIZE,
) -> CountVectorizerModel:
    """Binary bag-of-words model with the ``size`` most frequent terms.

    The terms are chosen by aggregation, so only those in the model reach the
    driver.  They arrive there from one sorted partition of at most ``size`` rows:
    the same texts give the same model, term by term, on any cluster.
    """
    stats = term_statistics(df, grams, min_df).persist()
    try:
        found = stats.count()
        if not found:
            raise ValueError(f"no term occurs in {min_df} texts")
        if found > size:
            logging.getLogger(__name__).warning(
                "the vocabulary keeps %d of %d terms in at least %d texts", size, found, min_df
            )
        chosen = stats if found <= size else most_frequent(stats, size)
        rows = (
            chosen.select("term")
            .repartition(1)
            .sortWithinPartitions("term")
            .select(F.array("term").alias(grams))
        )
        return CountVectorizer(
            inputCol=grams, outputCol=output, minDF=1.0, vocabSize=size, binary=True
        ).fit(rows)
    finally:
        stats.unpersist()


def vector_terms(
    df: DataFrame, model: CountVectorizerModel, keys: list[str], vector: str = "vectorized"
) -> DataFrame:
    """The terms present in each vector, one row each.

    The vocabulary has at most as many terms as it was fitted for, so it is the
    side to broadcast, unless its text is long; then both sides are shuffled.  Left
    to itself Spark may broadcast the other side, as it does not foresee how many rows
    the vectors unfold into.
    """
    terms = model.vocabulary
    names = df.sparkSession.createDataFrame(
        list(enumerate(terms)), "position int, term string"
    )
    small = sum(map(len, terms)) <= BROADCAST_CHARACTERS
    names = F.broadcast(names) if small else names.hint("merge")
    present = df.select(
        *keys, F.explode(F.unwrap_udt(F.col(vector))["indices"]).alias("position")
    )
    return present.join(names, "position").select(*keys, "term")
