import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import LONG
from pyspark.sql import functions as F

from threadtone.llm import language_id
from threadtone.llm.language_id import (
    SIZES, WIDTH, codewords, counts_of, fit_languages, held_out, languages_of, sums_of,
)


def grams(text):
    """Every n-gram of a text, as bytes with zero for a blank, in a plain way."""
    folded = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 0 for c in text.encode())
    words = [w for w in folded.split(b"\0") if w]
    for n in SIZES:
        for w in words:
            padded = w if n == 1 else b"\0" + w + b"\0"
            yield from (padded[i : i + n] for i in range(len(padded) - n + 1))


def bucket(gram):
    value = int.from_bytes(gram, "little")
    mixed = value * language_id._FACTORS[len(gram)] % 2**32
    return ((mixed ^ (mixed >> 15)) * 0x2C1B3C6D % 2**32) >> 17


TEXTS = ["", "A", "a b", "Éa, über-all 12x!", "\n\t .", "ÄÖ" * 40, "word " * 90, "x" * 500]


def brute_counts(texts):
    found = np.zeros(WIDTH, np.int64)
    for text in texts:
        for gram in grams(text):
            found[bucket(gram)] += 1
    return found


@pytest.mark.parametrize("piece", [5, 64, 1 << 18])
def test_counts_and_sums(monkeypatch, piece):
    """Whatever the pieces long texts are cut into."""
    monkeypatch.setattr(language_id, "PIECE", piece)
    texts = pa.array(TEXTS)
    assert (counts_of(texts) == brute_counts(TEXTS)).all()
    weights = np.random.default_rng(2).integers(-300, 300, (WIDTH, 5)).astype(np.int32)
    sums, number = sums_of(texts, weights)
    for i, text in enumerate(TEXTS):
        own = brute_counts([text])
        assert number[i] == own.sum() and (sums[i] == own @ weights).all()


@pytest.mark.parametrize("languages", [0, 1, 2, 3, 4, 6, 7, 30])
def test_codewords(languages):
    words = codewords(languages)
    assert len({tuple(w) for w in words.tolist()}) == languages
    if languages > 1:
        assert (words.min(0) != words.max(0)).all()
        apart = (words[:, None] != words[None]).sum(-1)[~np.eye(languages, dtype=bool)].min()
        assert apart >= (2 ** (languages - 2) if languages <= 6 else 8)
        columns = {min(tuple(c), tuple(1 - c)) for c in words.T}
        assert languages > 6 or len(columns) == words.shape[1] == 2 ** (languages - 1) - 1


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    codes = fit_languages(docs, ~held_out())
    assert codes.languages == ["de", "en", "es", "fr"] and np.allclose(codes.trust.sum(1), 1)
    rows = languages_of(docs, codes).join(docs.select("doc_id", "lang"), "doc_id").collect()
    kept = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(kept) == docs.where(held_out()).count() > 100
    assert sum(r.lang_pred == r.lang for r in kept) / len(kept) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)
    # Short pieces of held-out texts, of about eight words each.
    pieces = docs.where(held_out()).select("doc_id", "lang", F.explode(F.split("text", r"[.,]")).alias("text"))
    pieces = pieces.where(F.length("text") > 30).withColumn("doc_id", F.monotonically_increasing_id()).cache()
    found = languages_of(pieces, codes).join(pieces, "doc_id").select("lang", "lang_pred", "ambiguous").collect()
    right = [r.lang == r.lang_pred for r in found]
    assert sum(right) / len(right) > 0.97
    unsure = [r for r in found if r.ambiguous]
    sure = [r for r in found if not r.ambiguous]
    wrong = sum(r.lang != r.lang_pred for r in sure) / len(sure)
    assert not unsure or sum(r.lang != r.lang_pred for r in unsure) / len(unsure) > wrong


def test_same_result_however_dealt(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = fit_languages(docs.repartition(1), ~held_out())
    other = fit_languages(docs.repartition(7), ~held_out())
    assert (one.weights == other.weights).all() and (one.trust == other.trust).all()
    rows = [sorted(map(tuple, languages_of(docs.repartition(n), one).collect())) for n in (1, 5)]
    assert rows[0] == rows[1]


def test_odd_rows(spark, odd_docs, no_docs):
    codes = fit_languages(odd_docs, ~held_out())
    assert codes.languages == ["de", "en"]
    rows = languages_of(odd_docs, codes).collect()
    given = {(r.doc_id, r.text) for r in odd_docs.collect()}
    assert len(rows) == odd_docs.count() and {r.doc_id for r in rows} == {k for k, _ in given}
    letterless = {k for k, t in given if t is None or not any(map(str.isalpha, t))} - {None}
    assert {r.doc_id for r in rows if r.lang_pred == "und"} - {None} == letterless
    assert all(r.score == 0 and r.ambiguous for r in rows if r.lang_pred == "und")
    assert {r.lang_pred for r in rows if r.doc_id == 4} == {"en"} and len(LONG) > 300_000
    assert languages_of(no_docs, codes).count() == 0
    none = fit_languages(no_docs, ~held_out())
    assert none.languages == [] and {r.lang_pred for r in languages_of(odd_docs, none).collect()} == {"und"}


def test_one_and_many_languages(spark):
    rows = [(i, f"{chr(97 + i % 9) * 3} {chr(98 + i % 9) * 4} word", f"l{i % 9}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    codes = fit_languages(docs, F.lit(True))
    assert len(codes.languages) == 9
    found = {r.doc_id: r.lang_pred for r in languages_of(docs, codes).collect()}
    assert all(found[i] == lang for i, _, lang in rows)
    single = fit_languages(docs.where("lang = 'l3'"), F.lit(True))
    assert {(r.lang_pred, r.score) for r in languages_of(docs, single).collect()} == {("l3", 1.0)}
