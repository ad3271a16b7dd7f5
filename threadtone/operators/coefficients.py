"""Models as tables: a weight for each flag and term, an intercept for each flag.

In this form a model can be stored, looked at, compared and applied with joins and sums
alone.  ``plans.scoring`` applies the models themselves and shuffles no text; a table is
for models from elsewhere and for checks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadtone.operators.joins import BROADCAST_LABELS
from threadtone.operators.vocabulary import BROADCAST_CHARACTERS
from threadtone.session import fresh_path
from threadtone.sources.writers import write_then_read


def coefficient_table(
    spark: SparkSession,
    vocabulary: CountVectorizerModel,
    models: Mapping[str, CrossValidatorModel | LogisticRegressionModel],
) -> DataFrame:
    """``flag, term, weight``; the term NULL stands for the intercept.

    As many rows as the vocabulary has terms, which is bounded, for every model; weights
    of zero are left out.
    """
    rows = []
    for flag, model in models.items():
        best = getattr(model, "bestModel", model)
        weights = best.coefficients.toArray().tolist()
        rows.append((flag, None, float(best.intercept)))
        rows.extend((flag, t, w) for t, w in zip(vocabulary.vocabulary, weights, strict=True) if w)
    return spark.createDataFrame(rows, "flag string, term string, weight double")


def probabilities(
    texts: DataFrame,
    table: DataFrame,
    flags: Sequence[str],
    key: str = "id",
    grams: str = "grams",
    most: int = BROADCAST_CHARACTERS,
) -> DataFrame:
    """``key`` and, for each of ``flags``, the chance of class 1 by the table's model.

    A term counts once for a text.  Rows that share a key are one text, those without a
    known term get the intercept's chance.  The table is turned to one row a term, so
    each term of a text meets one row for all models.  It is broadcast, in blocks of
    about ``most`` characters with a pass over the texts each, so no term of a text is
    shuffled: a text's sums leave its task as one row.  Only the terms of keys that
    repeat are brought together first, as a term may be in several rows.
    """
    weight = {f: F.sum(F.when(F.col("flag") == f, F.col("weight"))) for f in flags}
    names = {f: f"__w{i}" for i, f in enumerate(flags)}
    wide = table.where(F.col("term").isNotNull()).groupBy("term").agg(
        *(weight[f].alias(names[f]) for f in flags)
    )
    base = table.where(F.col("term").isNull()).agg(*(weight[f].alias(names[f]) for f in flags))
    characters = wide.agg(F.sum(F.char_length("term") + 1)).first()[0] or 0
    blocks = max(1, -(-characters // most))
    block = F.pmod(F.xxhash64("term"), F.lit(blocks))
    terms = _terms_once(texts, key, grams)
    parts = [
        terms.join(F.broadcast(wide.where(block == i)), F.col("__term") == F.col("term"), "left")
        for i in range(blocks)
    ]
    found = reduce(DataFrame.unionAll, parts).groupBy("__key").agg(
        *(F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names.values())
    )

    def chance(f: str):
        intercept = F.coalesce(base.select(names[f]).scalar(), F.lit(0.0))
        return (1 / (1 + F.exp(-(F.col(names[f]) + intercept)))).alias(f)

    return found.select(F.col("__key").alias(key), *(chance(f) for f in flags))


def _terms_once(texts: DataFrame, key: str, grams: str) -> DataFrame:
    """``__key, __term``: each term of a key once; NULL for a row without terms."""
    spark = texts.sparkSession

    def terms(rows: DataFrame) -> DataFrame:
        return rows.select(F.col(key).alias("__key"), F.explode_outer(F.array_distinct(grams)).alias("__term"))

    sizes = texts.groupBy(F.col(key).alias("__again")).agg(F.count("*").alias("rows"))
    again = write_then_read(sizes.where("rows > 1").select("__again"), fresh_path(spark, "keys-again"))
    repeated = again.count()
    if not repeated:
        return terms(texts)
    again = F.broadcast(again) if repeated <= BROADCAST_LABELS else again.hint("merge")
    same = F.col(key).eqNullSafe(F.col("__again"))
    once, several = texts.join(again, same, "left_anti"), texts.join(again, same, "left_semi")
    return terms(once).unionAll(terms(several).distinct())
