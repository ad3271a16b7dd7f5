"""The given tables in the roles of the comment data.

Each event is one sighting of a comment: the comment's id is ``event_id div 10``,
which is a document id, and the document's text is the comment's body.  Four
comments in a row belong to one page, which stands for a submission.  The user's
nation stands for the state.  Labels give three targets, as in the labelled file:
quality, toxicity, and the balance of both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadtone.operators.classifier import Target
from threadtone.operators.joins import with_flags, with_submissions
from threadtone.plans.training import (
    Bundle,
    label_columns,
    train_once,
    with_binary_labels,
)
from threadtone.session import shared_folder
from threadtone.sources.materialize import fingerprint
from threadtone.sources.readers import read_table, spread

TARGETS = (
    Target("balance", "label_balance"),
    Target("quality", "label_quality"),
    Target("toxic", "label_toxic"),
)
TARGET_NAMES = [t.name for t in TARGETS]
FLAGS = label_columns(TARGETS)

# Fixed values of this workload: valid places, places off the map, a day to drop.
PLACES = tuple(f"NATION_{i}" for i in range(20))
OFF_MAP = ("NATION_8", "NATION_22")
DROPPED_DAY = "2024-01-15"
SEED = 7


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def bodies(spark: SparkSession, folder: str) -> DataFrame:
    """``id, body`` of all documents."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("body")
    )


def spread_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """The same, laid out for the text steps."""
    return spread(bodies(spark, folder))


def page_posts(spark: SparkSession, folder: str) -> DataFrame:
    """``id, body`` with links: each page's address, twice, around its source."""
    pages = table(spark, folder, "pages").select(
        F.col("page_id").alias("id"),
        F.concat(
            F.lit("See [the page]("), "url", F.lit(") or [here] "), "url",
            F.lit(" now... "), "html", F.lit(" via"), "url",
        ).alias("body"),
    )
    return spread(pages)


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Comment columns other than the body, one row per sighting."""
    events = table(spark, folder, "events")
    nation = table(spark, folder, "nation")
    comment = F.expr("event_id div 10")
    # Both timestamp kinds of Parquet give the same seconds in a UTC session.
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return events.join(nation, F.col("user_id") % 25 == F.col("n_nationkey")).select(
        comment.alias("id"),
        F.concat(F.lit("t3_"), F.expr("event_id div 10 div 4")).alias("link_id"),
        seconds.alias("created_utc"),
        F.floor("value").alias("score"),
        F.col("n_name").alias("author_flair_text"),
    )


def submissions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("id"),
        F.length("url").cast("bigint").alias("score"),
    )


def labeled(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled file: ids and three label columns, all of them text."""
    quality, toxic = F.col("quality"), F.col("toxic")
    return table(spark, folder, "labels").select(
        F.col("doc_id").alias("Input_id"),
        (quality - toxic).cast("string").alias("label_balance"),
        (quality * 2 - 1).cast("string").alias("label_quality"),
        (toxic * 2 - 1).cast("string").alias("label_toxic"),
    )


def label_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Flags straight from the labels: the same on every engine."""
    return with_binary_labels(labeled(spark, folder), TARGETS).select(
        F.col("Input_id").alias("id"), *FLAGS
    )


def sightings(spark: SparkSession, folder: str) -> DataFrame:
    return with_submissions(metadata(spark, folder), submissions(spark, folder))


def flagged(spark: SparkSession, folder: str) -> DataFrame:
    """Comment columns of every sighting of a labelled comment, with its flags."""
    return metadata(spark, folder).join(label_flags(spark, folder), "id")


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """All comment columns, one row per sighting of a comment that has a body."""
    return metadata(spark, folder).join(bodies(spark, folder), "id")


def sentiment(spark: SparkSession, folder: str) -> DataFrame:
    """Sightings with the flags of their labels."""
    return with_flags(sightings(spark, folder), label_flags(spark, folder))


def trained(spark: SparkSession, folder: str) -> str:
    """Folder of the models and their metrics, trained on first use.

    Keyed by the application too: a later run, of newer code perhaps, trains anew.
    """
    paths = [f"{folder}/documents.parquet", f"{folder}/labels.parquet"]
    params = {
        "targets": [repr(t) for t in TARGETS],
        "seed": SEED,
        "application": spark.sparkContext.applicationId,
    }
    home = f"{shared_folder(spark)}/models-{fingerprint(spark, paths, params)}"
    return train_once(home, labeled(spark, folder), bodies(spark, folder), TARGETS, SEED)


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{trained(spark, folder)}/metrics")


def bundle(spark: SparkSession, folder: str) -> Bundle:
    return Bundle.load(trained(spark, folder), TARGETS)
