"""A file of JSON lines with a body each, to its cleaned texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadtone import schemas
from threadtone.functions.text import with_parsed
from threadtone.session import fresh_path
from threadtone.sources.readers import Paths, accepted, checked_json, rejected
from threadtone.sources.writers import write_table, write_then_read


def clean_bodies(spark: SparkSession, path: Paths, quarantine: str | None = None) -> DataFrame:
    """``parsed, unigrams, bigrams, trigrams`` of every line, plain or bz2.

    Lines that are no JSON object give no row; with ``quarantine`` they are written
    there as ``file, record``.
    """
    checked = checked_json(spark, path, schemas.BODIES)
    if quarantine:
        checked = write_then_read(checked, fresh_path(spark, "checked-bodies"))
        write_table(rejected(checked), quarantine)
    return with_parsed(accepted(checked)).select("parsed", "unigrams", "bigrams", "trigrams")
