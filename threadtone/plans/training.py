"""Labelled comments to classifiers: one vocabulary, two models per target."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from math import ceil
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadtone.constants import (
    FOLDS,
    MIN_DOCUMENT_FREQUENCY,
    REGULARISATION_GRID,
    TRAIN_FRACTION,
    VOCABULARY_SIZE,
)
from threadtone.functions.sampling import hash_parts, stratified_folds
from threadtone.functions.scalars import negative_label, positive_label
from threadtone.functions.text import with_grams
from threadtone.operators.classifier import (
    NEGATIVE,
    POSITIVE,
    Target,
    cross_validate,
    holdout_auc,
)
from threadtone.operators.joins import dealt, labelled_comments
from threadtone.operators.solver import MOST_GRADIENTS, store_rows
from threadtone.operators.vocabulary import fit_vocabulary
from threadtone.session import fresh_path
from threadtone.sources.filesystem import exists, private_path, remove, replaced, settled
from threadtone.sources.writers import write_table, write_then_read

# Each pass over the data costs every task a gradient as long as the vocabulary, so a
# partition should hold rows enough to be worth one.
ROWS_PER_PARTITION = 4096
CONCURRENT_MODELS = 6
# Folds must not follow the split into halves, so they go by another seed.
FOLD_SEED = 1


def label_columns(targets: Sequence[Target]) -> list[str]:
    return [f"{t.name}_{kind}" for t in targets for kind in (POSITIVE, NEGATIVE)]


def with_binary_labels(df: DataFrame, targets: Sequence[Target]) -> DataFrame:
    """Add the 0/1 columns ``<target>_pos`` and ``<target>_neg``."""
    labels = {}
    for t in targets:
        labels[f"{t.name}_{POSITIVE}"] = positive_label(F.col(t.label))
        labels[f"{t.name}_{NEGATIVE}"] = negative_label(F.col(t.label))
    return df.withColumns(labels)


def labelled_grams(
    labeled: DataFrame, comments: DataFrame, targets: Sequence[Target]
) -> DataFrame:
    """``Input_id``, the binary labels and the gram list of each labelled comment.

    The joined rows are dealt out before the text steps, since what the join
    leaves of the comments may be little and unevenly spread.
    """
    raw = labelled_comments(labeled, comments, [t.label for t in targets])
    return with_grams(with_binary_labels(dealt(raw), targets)).select(
        "Input_id", *label_columns(targets), "grams"
    )


def _each(work: Callable[[str], Any], names: Sequence[str]) -> list[Any]:
    # A model is fitted, saved or loaded by a chain of short Spark jobs.  Issued
    # one model after the other they would leave most of a cluster idle.
    spark = SparkSession.getActiveSession()
    with ThreadPoolExecutor(CONCURRENT_MODELS) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), names))


@dataclass(frozen=True)
class Bundle:
    """What scoring needs: the vocabulary and the models by flag column."""

    targets: tuple[Target, ...]
    vocabulary: CountVectorizerModel
    models: dict[str, CrossValidatorModel]

    def save(self, folder: str) -> None:
        """Write all models to ``folder``, replacing what is there once all are written."""
        spark = SparkSession.getActiveSession()
        attempt = private_path(folder)
        self._write(attempt)
        replaced(spark, attempt, folder)

    def _write(self, folder: str) -> None:
        def save_one(name: str) -> None:
            self.models[name].write().save(f"{folder}/{name}.model")

        self.vocabulary.write().save(f"{folder}/vocabulary")
        _each(save_one, list(self.models))

    @classmethod
    def load(cls, folder: str, targets: Sequence[Target]) -> Bundle:
        def load_one(name: str) -> CrossValidatorModel:
            return CrossValidatorModel.load(f"{folder}/{name}.model")

        names = label_columns(targets)
        models = dict(zip(names, _each(load_one, names), strict=True))
        vocabulary = CountVectorizerModel.load(f"{folder}/vocabulary")
        return cls(tuple(targets), vocabulary, models)


@dataclass(frozen=True)
class Trained:
    """Models with their cross-validated and held-out area under ROC."""

    bundle: Bundle
    cv_auc: dict[str, float]
    holdout_auc: dict[str, float]

    def metrics(self, spark: SparkSession) -> DataFrame:
        rows = [
            (t.name, kind, self.cv_auc[name], self.holdout_auc.get(name))
            for t in self.bundle.targets
            for kind in (POSITIVE, NEGATIVE)
            for name in (f"{t.name}_{kind}",)
        ]
        return spark.createDataFrame(
            rows, "target string, flag string, cv_auc double, holdout_auc double"
        )


def train(
    labeled: DataFrame,
    comments: DataFrame,
    targets: Sequence[Target],
    seed: int = 0,
    min_df: int = MIN_DOCUMENT_FREQUENCY,
    vocabulary_size: int = VOCABULARY_SIZE,
    grid: Sequence[float] = REGULARISATION_GRID,
    folds: int = FOLDS,
    evaluate: bool = True,
) -> Trained:
    """Fit the vocabulary on all labelled comments and the models on half of them.

    The split and the folds go by comment id, so they are the same on every run and
    cluster.  Each model's folds are dealt out within its two classes, so a rare class is
    in all of them.  As many folds are fitted at a time as the cluster has room for.  The
    gram table, from which the vocabulary and every model start, is stored for the time
    of the training.
    """
    spark = comments.sparkSession
    home = fresh_path(spark, "labelled-grams")
    grams = write_then_read(labelled_grams(labeled, comments, targets), home)
    vocabulary = fit_vocabulary(grams, min_df=min_df, size=vocabulary_size)
    names = label_columns(targets)
    partitions = max(1, ceil(grams.count() / ROWS_PER_PARTITION))
    halves = (TRAIN_FRACTION, 1.0 - TRAIN_FRACTION)
    parts = hash_parts(grams, "Input_id", halves, seed)
    dealt = stratified_folds(
        parts.where("part = 1").select("Input_id", *names), "Input_id", names, folds, seed + FOLD_SEED
    ).withColumnRenamed("Input_id", "__id")
    features = vocabulary.transform(parts).select("Input_id", *names, "part", "vectorized")
    features = features.join(dealt, F.col("Input_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    # Rows are dealt out in turn, so copies of one comment cannot fill a partition.
    # They are kept on disk: as large arrays they would leave a heap no room.
    features = features.repartition(partitions).sortWithinPartitions("Input_id").persist(StorageLevel.DISK_ONLY)
    slots = spark.sparkContext.defaultParallelism
    gradients = min(partitions, MOST_GRADIENTS)
    folds_at_a_time = max(1, min(folds, slots // gradients))
    learn, held_out = features.where("part = 1"), features.where("part = 2")
    # One pass fills the cache before the threads start asking for it, and stores what all
    # models are fitted from.
    rows = fresh_path(spark, "rows-to-fit")
    store_rows(learn, "vectorized", [*names, *(f"fold_{n}" for n in names)], rows)

    def fit(name: str) -> tuple[str, CrossValidatorModel, float | None]:
        model = cross_validate(
            learn.coalesce(gradients), name, seed=seed, grid=grid, folds=folds,
            parallelism=folds_at_a_time, fold=f"fold_{name}", stored=rows,
        )
        return name, model, holdout_auc(model, held_out, name) if evaluate else None

    try:
        fits = _each(fit, names)
    finally:
        features.unpersist()
        remove(spark, home)
        remove(spark, rows)
    return Trained(
        Bundle(tuple(targets), vocabulary, {name: model for name, model, _ in fits}),
        {name: float(max(model.avgMetrics)) for name, model, _ in fits},
        {name: auc for name, _, auc in fits if auc is not None},
    )


def train_once(
    home: str,
    labeled: DataFrame,
    comments: DataFrame,
    targets: Sequence[Target],
    seed: int,
    **settings: Any,
) -> str:
    """Models and metrics below ``home``, trained unless they are there already.

    They are written to a folder of this training's own, the metrics last, which is then
    renamed: of two trainings at once both go on with the models of the first to finish.
    ``settings`` go to ``train``.
    """
    spark = comments.sparkSession
    marker = "metrics/_SUCCESS"
    if not exists(spark, f"{home}/{marker}"):
        outcome = train(labeled, comments, targets, seed, **settings)
        attempt = private_path(home)
        outcome.bundle._write(attempt)
        write_table(outcome.metrics(spark), f"{attempt}/metrics")
        settled(spark, attempt, home, marker)
    return home
