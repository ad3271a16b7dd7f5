"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadtone.llm.common import table
from threadtone.llm.decontaminate import contamination
from threadtone.llm.exact_dedup import exact_dedup
from threadtone.llm.fill_in_middle import fill_in_middle, restored
from threadtone.llm.language_id import fit_languages, held_out, languages_of
from threadtone.llm.mixing import mix
from threadtone.llm.product_codes import label_errors, product_codes
from threadtone.llm.quality import THRESHOLD, fit_quality, grade_of, graded
from threadtone.llm.sharding import balanced_shards
from threadtone.llm.simhash import near_duplicates
from threadtone.llm.substring_dedup import without_repeats
from threadtone.llm.suffix_dedup import without_seen_bytes
from threadtone.llm.token_files import read_back, write_token_files
from threadtone.llm.warc import derive, read_records, write_responses
from threadtone.session import fresh_path


#: The tree of the corpus: which sources make up a domain, and the target weights.
DOMAINS = {
    "web": [f"src{i}" for i in range(10)],
    "books": [f"src{i}" for i in range(10, 15)],
    "forum": [f"src{i}" for i in range(15, 20)],
}
WEIGHTS = {"web": 5, "books": 3, "forum": 2, "web/en": 6, "web/fr": 2, "web/de": 2}
WEIGHTS |= {"books/en": 4, "forum/en": 4, "web/en/src0": 3}


def domain_of(source: str) -> Column:
    """The domain a source belongs to; ``other`` for those of none."""
    found = F.lit("other")
    for domain, sources in DOMAINS.items():
        found = F.when(F.col(source).isin(sources), F.lit(domain)).otherwise(found)
    return found


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the runs of sentences that occur before, and where those were."""
    cleaned = without_repeats(table(spark, folder, "documents"))
    spans = F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["stop"]))
    return cleaned.select(
        "doc_id",
        "n_units",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(spans, ",").alias("removed"),
        "text",
    )


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the bytes seen before it."""
    found = without_seen_bytes(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Where every document's ids are, and their checksum, read back from the files."""
    docs = table(spark, folder, "documents")
    target = fresh_path(spark, "token-files")
    write_token_files(docs, target, public_tokenizers.path("byte_bpe_50k.json"))
    return read_back(docs, target)


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade, chance of the highest grade and choice, for every document."""
    docs = table(spark, folder, "documents")
    grades = table(spark, folder, "labels").select("doc_id", grade_of().alias("grade"))
    found = graded(docs, fit_quality(docs, grades))
    return found.withColumn("kept", F.col("tail") >= THRESHOLD)


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard and slot of every document; row counts differ by one at most."""
    placed = balanced_shards(table(spark, folder, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, folder, "documents"))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", text.alias("fingerprint"), "component_id")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The documents and epochs that a mix of half the corpus takes."""
    docs = table(spark, folder, "documents")
    mixed = mix(docs, domain_of("source"), F.col("lang"), F.col("source"), WEIGHTS)
    return mixed.select(
        "doc_id",
        F.col("mix_domain").alias("domain"),
        "lang",
        "source",
        F.col("mix_tokens").alias("tokens"),
        F.col("mix_epoch").alias("epoch"),
    )


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The derivatives of every page's response, as read back from their files.

    A row per record: its page (null if it has no key), identifiers, digest, and its text.
    """
    responses, derivatives = fresh_path(spark, "responses"), fresh_path(spark, "derivatives")
    write_responses(table(spark, folder, "pages"), responses)
    derive(spark, responses, derivatives)
    return read_records(spark, derivatives).select(
        F.element_at("headers", "X-Page-Key").try_cast("long").alias("page_id"),
        "type",
        "uri",
        "date",
        "record_id",
        "refers_to",
        "block_digest",
        F.decode("block", "UTF-8").alias("content"),
    )


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of benchmark passages in every document."""
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The row that stays, for every document."""
    return exact_dedup(table(spark, folder, "documents"))


def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents")
    found = languages_of(docs, fit_languages(docs, ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its lines cut at two ranks, and the text made whole again."""
    made = fill_in_middle(table(spark, folder, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_product_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The code of every vector, its error and that of its label."""
    coded = product_codes(table(spark, folder, "embeddings"))
    numbers = ",".join(map(str, coded.books.ravel().tolist()))
    return label_errors(coded.rows).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_token_files": op3_token_files,
    "op4_quality": op4_quality,
    "op5_sharding": op5_sharding,
    "op6_simhash": op6_simhash,
    "op7_mixing": op7_mixing,
    "op8_warc": op8_warc,
    "op9_decontamination": op9_decontamination,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_language_id": op11_language_id,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_product_codes": op13_product_codes,
}
