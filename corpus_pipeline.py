"""A training corpus from ``documents``, in stages that each call one operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadtone.llm.common import stored, table
from threadtone.llm.decontaminate import clean_documents
from threadtone.llm.mixing import mix
from threadtone.llm.quality import good_documents, grade_of
from threadtone.llm.queries import WEIGHTS, domain_of
from threadtone.llm.simhash import one_of_each
from threadtone.llm.token_files import read_back, write_token_files
from threadtone.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good by a model fitted on the rated ones among them."""
    return good_documents(docs, table(spark, sf_dir, "labels").select("doc_id", grade_of().alias("grade")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest key.

    Copies' fingerprints of three-word shingles differ in three bits at most.
    """
    return one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, by the target weights; a row for each epoch."""
    chosen = mix(docs, domain_of("source"), F.col("lang"), F.col("source"), WEIGHTS, share=(1, 1))
    return chosen.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every document's ids are in the token files, and their checksum."""
    folder = fresh_path(spark, "corpus")
    write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_back(docs, folder)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("tokens", tokens),
]

#: The model, the fingerprints and the tokenizer are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
