"""From the three input files to the published shares."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from threadtone import schemas
from threadtone.constants import (
    FOLDS,
    MIN_DOCUMENT_FREQUENCY,
    REGULARISATION_GRID,
    SAMPLE_FRACTION,
    STATES,
    VOCABULARY_SIZE,
)
from threadtone.operators.classifier import TARGETS, Target
from threadtone.plans.publishing import publish
from threadtone.plans.scoring import sentiment, unseen_comments
from threadtone.plans.training import Bundle, train_once
from threadtone.session import shared_folder
from threadtone.sources.materialize import fingerprint, materialize
from threadtone.sources.readers import (
    Paths,
    accepted,
    checked_csv,
    checked_json,
    rejected,
    spread,
)


def run(
    spark: SparkSession,
    labeled: Paths,
    comments: Paths,
    submissions: Paths,
    output: str,
    targets: Sequence[Target] = TARGETS,
    states: Sequence[str] = STATES,
    fraction: float = SAMPLE_FRACTION,
    seed: int = 0,
    model_folder: str | None = None,
    min_df: int = MIN_DOCUMENT_FREQUENCY,
    vocabulary_size: int = VOCABULARY_SIZE,
    grid: Sequence[float] = REGULARISATION_GRID,
    folds: int = FOLDS,
) -> list[str]:
    """Train or load the models, score a sample, write the CSV files.

    Each input is a path, a pattern or a list of them.  The inputs are kept as Parquet
    in the shared folder, as are the models and the flag table, all under fingerprints
    of the files and parameters they were made from.  Records that are malformed stay in
    those copies, with their file, and are counted in the log.  With ``model_folder`` naming
    stored models nothing is trained.
    """
    settings = {
        "min_df": min_df,
        "vocabulary_size": vocabulary_size,
        "grid": tuple(grid),
        "folds": folds,
    }

    def stored(name: str, path: Paths, read, schema) -> tuple:
        key = fingerprint(spark, [path] if isinstance(path, str) else path, {})
        table = materialize(spark, name, lambda: read(spark, path, schema), key)
        lost = rejected(table).count()
        if lost:
            logging.getLogger(__name__).warning("%d malformed records in %s", lost, path)
        return key, accepted(table)

    labeled_key, labeled_df = stored("labeled", labeled, checked_csv, schemas.LABELED)
    comments_key, comments_df = stored("comments", comments, checked_json, schemas.COMMENTS)
    submissions_key, submissions_df = stored(
        "submissions", submissions, checked_json, schemas.SUBMISSIONS
    )

    names = [repr(t) for t in targets]
    if model_folder:
        models_key = fingerprint(spark, [model_folder], {"targets": names})
    else:
        made_from = {
            "inputs": [labeled_key, comments_key],
            "targets": names,
            "seed": seed,
            "settings": settings,
        }
        models_key = fingerprint(spark, [], made_from)
        model_folder = f"{shared_folder(spark)}/models-{models_key}"
        train_once(model_folder, labeled_df, comments_df, targets, seed, **settings)
    bundle = Bundle.load(model_folder, targets)

    params = {
        "inputs": [comments_key, submissions_key, models_key],
        "targets": names,
        "fraction": fraction,
        "seed": seed,
    }
    flag_table = materialize(
        spark,
        "sentiment",
        lambda: sentiment(
            unseen_comments(spread(comments_df), fraction, seed), submissions_df, bundle
        ),
        fingerprint(spark, [], params),
    )
    return publish(flag_table, [t.name for t in targets], output, states)
