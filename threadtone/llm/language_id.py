"""Language ID by error-correcting output codes over byte n-grams.

Every language gets a codeword of bits.  For each bit a binary classifier tells the
languages that have it from those that have not: naive Bayes over hashed n-grams, each
language weighing the same on its side.  Counts of n-grams are sums over all texts to
learn from, taken in tasks.  A second pass over the same texts measures how often each
bit is right for each language; those shares weigh the losses when a text's margins are
decoded to the nearest codeword.  Weights are whole numbers, so a text's margins do not
depend on how it was batched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtone.llm.common import text_or_empty

#: Bytes in an n-gram, and the number of buckets all n-grams are hashed into.
SIZES = (1, 2, 3, 4)
WIDTH = 1 << 15
#: Added to every count; log odds are cut at this and stored in steps of 1 / STEPS.
SMOOTHING, MOST_ODDS, STEPS = 0.5, 6.0, 64
#: A text's evidence counts as that of at most so many n-grams.
EVIDENCE = 48
#: Up to so many languages all distinct splits of them are bits; beyond, random ones.
EXHAUSTIVE = 6
#: A text is ambiguous if the second codeword's loss is within this share of the first's.
AMBIGUOUS = 0.2
#: Bytes of text worked on at once, and languages a task counts for before it sends.
PIECE = 1 << 18
HELD = 32
#: What a text without a letter is.
UNKNOWN = "und"

_FOLD = np.zeros(256, np.uint32)
for _c in range(128, 256):
    _FOLD[_c] = _c
for _c in range(97, 123):
    _FOLD[_c] = _FOLD[_c - 32] = _c
_FACTORS = {1: 0x9E3779B1, 2: 0x85EBCA6B, 3: 0xC2B2AE35, 4: 0x27D4EB2F}


def _pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Folded bytes of some texts, a blank before and blanks after each, and whose they are.

    Yields ``(bytes, starts, rows)``: the n-grams that begin from ``starts[i]`` up to the
    next start belong to row ``rows[i]``, or to none if that is -1.  A long text is cut
    and each cut followed by the bytes its last n-grams reach into.
    """
    reach, held, starts, rows, size = max(SIZES) - 1, [], [], [], 0
    gap = np.zeros(max(SIZES), np.uint32)
    for row, text in enumerate(texts):
        raw = text.as_buffer()
        data = np.frombuffer(raw, np.uint8) if raw.size else np.zeros(0, np.uint8)
        for start in range(0, len(data) + 1, PIECE):
            end = min(start + PIECE, len(data) + 1)
            own = np.zeros(end - start + reach, np.uint32)
            first, last = max(start, 1), min(end + reach, len(data) + 1)
            own[first - start : last - start] = _FOLD[data[first - 1 : last - 1]]
            held.append(own)
            starts += [size, size + end - start]
            rows += [row, -1]
            size += len(own)
            if size >= PIECE:
                yield np.concatenate([*held, gap]), np.array(starts), np.array(rows)
                held, starts, rows, size = [], [], [], 0
    if rows:
        yield np.concatenate([*held, gap]), np.array(starts), np.array(rows)


def _hashed(data: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at every place, and where there is one.

    An n-gram is letters, with a blank before or after a word's first or last ones.
    """
    count = len(data) - max(SIZES)
    value = data[:count].copy()
    blank = value == 0
    valid = ~blank if n == 1 else np.ones(count, bool)
    for i in range(1, n):
        part = data[i : i + count]
        now = part == 0
        value |= part << np.uint32(8 * i)
        valid &= ~(blank & now)
        if 0 < i < n - 1:
            valid &= ~now
        blank = now
    mixed = value * np.uint32(_FACTORS[n])
    return (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17), valid


def counts_of(texts: pa.Array) -> np.ndarray:
    """How often each bucket occurs in the texts."""
    found = np.zeros(WIDTH, np.int64)
    for data, starts, rows in _pieces(texts):
        lengths = np.diff(np.append(starts, len(data) - max(SIZES)))
        mine = np.repeat(rows >= 0, lengths)
        for n in SIZES:
            buckets, valid = _hashed(data, n)
            found += np.bincount(buckets[valid & mine], minlength=WIDTH)
    return found


def sums_of(texts: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By text: the sum of its n-grams' ``weights`` for every bit, and their number."""
    sums = np.zeros((len(texts), weights.shape[1] + 1), np.int64)
    table = np.concatenate([weights, np.ones((len(weights), 1), weights.dtype)], 1)
    table = np.concatenate([table, np.zeros((1, table.shape[1]), table.dtype)])
    for data, starts, rows in _pieces(texts):
        for n in SIZES:
            buckets, valid = _hashed(data, n)
            found = table[np.where(valid, buckets, len(weights))]
            part = np.add.reduceat(found, starts, axis=0)
            np.add.at(sums, rows[rows >= 0], part[rows >= 0])
    return sums[:, :-1], sums[:, -1]


def codewords(languages: int, seed: int = 11) -> np.ndarray:
    """``(languages, bits)`` of 0 and 1, all rows distinct and no column constant.

    Few languages get every distinct split into two; more get, of many seeded drawings
    of about ten bits for each doubling, the one whose nearest rows are farthest apart.
    """
    if languages <= 1:
        return np.ones((languages, 1), np.int64)
    if languages <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (languages - 1))
        bits = (splits[None] >> np.arange(languages - 1)[:, None]) & 1
        return np.concatenate([np.zeros((1, len(splits)), np.int64), bits])
    draw, best, apart = np.random.Generator(np.random.PCG64(seed)), None, -1
    width = int(np.ceil(10 * np.log2(languages)))
    for _ in range(200):
        bits = draw.integers(0, 2, (languages, width))
        flat = (bits.min(0) == bits.max(0)).nonzero()[0]
        bits[0, flat] ^= 1
        same = bits @ bits.T + (1 - bits) @ (1 - bits).T
        np.fill_diagonal(same, 0)
        if width - same.max() > apart:
            best, apart = bits, width - same.max()
    return best


@dataclass
class Codes:
    """The learned languages, their codewords, every bit's weights, and the bits' trust."""

    languages: list[str]
    words: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def margins(self, texts: pa.Array) -> np.ndarray:
        """By text and bit, positive where the bit is taken for 1."""
        sums, grams = sums_of(texts, self.weights)
        damp = np.minimum(1.0, EVIDENCE / np.maximum(grams, 1))
        return sums * (damp / STEPS)[:, None]

    def decoded(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword, score and ambiguity: each bit's loss is weighed by its trust."""
        signs = 2 * self.words - 1
        losses = np.stack(
            [(t * np.logaddexp(0, -s * margins)).sum(1) for s, t in zip(signs, self.trust)], 1
        )
        best = losses.argmin(1)
        chance = np.exp(losses.min(1, keepdims=True) - losses)
        score = np.round(1 / chance.sum(1), 6)
        if losses.shape[1] < 2:
            return best, score, np.zeros(len(best), bool)
        first, second = np.partition(losses, 1, axis=1)[:, :2].T
        return best, score, second - first <= AMBIGUOUS * second


def _fitted(languages: list[str], counts: np.ndarray) -> Codes:
    words = codewords(len(languages))
    shares = (counts + SMOOTHING) / (counts.sum(1, keepdims=True) + SMOOTHING * WIDTH)
    ones = words.T @ shares / np.maximum(words.sum(0), 1)[:, None]
    zeros = (1 - words).T @ shares / np.maximum((1 - words).sum(0), 1)[:, None]
    floor = 1.0 / WIDTH if len(languages) < 2 else 0.0
    odds = np.log(np.maximum(ones, floor)) - np.log(np.maximum(zeros, floor))
    seen = counts.sum(0) > 0
    weights = np.where(seen[None], np.clip(odds, -MOST_ODDS, MOST_ODDS) * STEPS, 0).round().T
    trust = np.full(words.shape, 1.0 / words.shape[1])
    return Codes(languages, words, weights.astype(np.int32), trust)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for lang, found in held.items():
            at = np.flatnonzero(found)
            arrays = [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(found[at])]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "bucket", "n"])
        held.clear()

    for batch in batches:
        langs = batch.column("lang")
        for lang in langs.unique().to_pylist():
            mine = pc.equal(langs, lang)
            if lang not in held and len(held) >= HELD:
                yield from sent()
            held[lang] = held.get(lang, 0) + counts_of(batch.column("text").filter(mine))
    yield from sent()


def _proved(batches: Iterator[pa.RecordBatch], codes: Codes) -> Iterator[pa.RecordBatch]:
    """By language: texts, and how many of them each bit gets right."""
    number = {lang: i for i, lang in enumerate(codes.languages)}
    right = np.zeros((len(number), codes.words.shape[1] + 1), np.int64)
    for batch in batches:
        own = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
        fits = (codes.margins(batch.column("text")) > 0) == (codes.words[own] == 1)
        np.add.at(right, own, np.concatenate([fits, np.ones((len(own), 1), bool)], 1))
    slots = np.flatnonzero(right)
    yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(right.ravel()[slots])], ["slot", "n"])


def fit_languages(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> Codes:
    """Codes learned from all rows of ``docs`` where ``learn`` holds and ``lang`` is not null.

    The driver gets one number for every language and bucket, and one for every language
    and bit; no text and no row.  Without such rows there are no languages.
    """
    rows = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    found = rows.mapInArrow(_counted, "lang string, bucket int, n long")
    found = found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    if not languages:
        return Codes([], np.zeros((0, 1), np.int64), np.zeros((WIDTH, 1), np.int32), np.zeros((0, 1)))
    number = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((len(languages), WIDTH))
    counts[found["lang"].map(number), found["bucket"]] = found["n"]
    codes = _fitted(languages, counts)
    right = np.zeros((len(languages), codes.words.shape[1] + 1))
    proved = rows.mapInArrow(partial(_proved, codes=codes), "slot long, n long")
    for slot, n in proved.groupBy("slot").agg(F.sum("n")).collect():
        right.reshape(-1)[slot] = n
    trust = right[:, :-1] / np.maximum(right[:, -1:], 1)
    total = trust.sum(1, keepdims=True)
    codes.trust = np.where(total > 0, trust / np.maximum(total, 1e-9), codes.trust)
    return codes


def languages_of(docs: DataFrame, codes: Codes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score, ambiguous`` of every row, from its text alone.

    A null text, one without a letter and, if nothing was learned, any text is ``und``
    with score 0 and ambiguous.  Whole texts count, very long ones piece by piece.  Equal
    texts get equal results, so repeated rows do.  A null key stays null; other columns
    are not read; an empty table gives an empty one.
    """
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(key).alias("id"), text_or_empty(text).alias("text"), letters.alias("letters"))
    kind = rows.schema["id"].dataType.simpleString()
    names = np.array([*codes.languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            if not codes.languages:
                known[:] = False
            best = np.full(len(batch), len(names) - 1)
            score, unsure = np.zeros(len(batch)), np.ones(len(batch), bool)
            if known.any():
                margins = codes.margins(batch.column("text").filter(pa.array(known)))
                best[known], score[known], unsure[known] = codes.decoded(margins)
            arrays = [batch.column("id"), pa.array(names[best], pa.string()), pa.array(score), pa.array(unsure)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "lang_pred", "score", "ambiguous"])

    found = rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, ambiguous boolean")
    return found.withColumnRenamed("id", key)


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is kept out of learning: crc32 of its key as text, modulo ``folds``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds == 0
