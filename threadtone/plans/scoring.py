"""Unseen comments to flags.

The flags of all targets come from one pass over the text, with the comment's
metadata carried along.  Nothing is joined back by comment id, so the body of a
comment is never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadtone.constants import SAMPLE_FRACTION
from threadtone.functions.sampling import bernoulli_sample, hash_sample
from threadtone.functions.scalars import class1_probability, flag, is_fresh_comment
from threadtone.functions.text import with_grams
from threadtone.operators.classifier import NEGATIVE, POSITIVE, add_probability
from threadtone.operators.joins import with_submissions
from threadtone.plans.training import Bundle, label_columns


def unseen_comments(
    comments: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    seed: int = 0,
    by_hash: bool = True,
) -> DataFrame:
    """A sample of the comments that neither quote nor are marked as sarcasm."""
    fresh = comments.where(is_fresh_comment(F.col("body")))
    if by_hash:
        return hash_sample(fresh, "id", fraction, seed)
    return bernoulli_sample(fresh, fraction, seed)


def score(unseen: DataFrame, bundle: Bundle) -> DataFrame:
    """Add ``<target>_pos_prob, <target>_neg_prob`` vectors; ``body`` is consumed."""
    scored = bundle.vocabulary.transform(with_grams(unseen)).drop("grams")
    for name in label_columns(bundle.targets):
        scored = add_probability(scored, bundle.models[name], f"{name}_prob")
    return scored


def flags(scored: DataFrame, bundle: Bundle) -> DataFrame:
    """Replace the probabilities by the 0/1 flags ``<target>_pos, <target>_neg``."""
    columns = {}
    for t in bundle.targets:
        limits = {POSITIVE: t.positive_threshold, NEGATIVE: t.negative_threshold}
        for kind, limit in limits.items():
            probability = class1_probability(F.col(f"{t.name}_{kind}_prob"))
            columns[f"{t.name}_{kind}"] = flag(probability, limit)
    spent = [f"{name}_prob" for name in label_columns(bundle.targets)]
    return scored.withColumns(columns).drop("vectorized", *spent)


def sentiment(
    unseen: DataFrame,
    submissions: DataFrame,
    bundle: Bundle,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Flags of every target next to comment and submission metadata.

    ``carry=("body",)`` keeps the text; without it only a few narrow columns go
    through the shuffle by submission.
    """
    kept = {f"__{c}": F.col(c) for c in carry}
    flagged = flags(score(unseen.withColumns(kept) if kept else unseen, bundle), bundle)
    for c in carry:
        flagged = flagged.withColumn(c, F.col(f"__{c}")).drop(f"__{c}")
    return with_submissions(
        flagged, submissions, carry=[*label_columns(bundle.targets), *carry]
    )
