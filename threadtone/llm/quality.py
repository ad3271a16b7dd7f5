"""Quality classifier: ordinal regression of a text's grade.

A cumulative-link model: P(grade <= k) = sigmoid(threshold_k - score), one weight per
hashed feature for all thresholds.  It is fitted on a bounded sample of the graded
texts, which is all that reaches the driver; every text is scored in tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from threadtone.llm.common import stored

#: Features are hashed into so many weights.
WIDTH = 1 << 18
#: Graded texts the model is fitted on at most: those with the smallest hash of the key.
SAMPLE = 12_000
#: Features that fewer texts of the sample have get no weight.
MIN_ROWS = 8
#: The chance of the highest grade from which a text is kept.
THRESHOLD = 0.6
#: Distinct tokens a worker remembers.
REMEMBERED = 1_000_000
_JUDGED = StructType([StructField("expected_grade", DoubleType()), StructField("tail", DoubleType())])
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def _level(part: int, whole: int, steps: int = 10) -> int:
    return steps * part // whole if whole else -1


class Features:
    """Hashed features of a text: its distinct words and signs, and how it is made."""

    def __init__(self, width: int = WIDTH) -> None:
        self.width = width
        self.known: dict[str, int] = {}

    def _of(self, name: str) -> int:
        found = self.known.get(name)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known = {}
            found = self.known[name] = xxhash.xxh64_intdigest(name.encode(), 7) % self.width
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        tokens = _TOKEN.findall(text)
        words = [t for t in tokens if t.isalpha()]
        letters = sum(map(len, words))
        lower = set(map(str.lower, tokens))
        shape = {
            "signs": _level(len(tokens) - len(words), len(tokens)),
            "distinct": _level(len(lower), len(tokens)),
            "upper": _level(sum(w.isupper() and len(w) > 1 for w in words), len(words)),
            "letters": _level(letters, len(text)),
            "again": _level(sum(a == b for a, b in zip(words, words[1:])), len(words)),
            "size": len(tokens).bit_length(),
        }
        names = [f" {name} {value}" for name, value in shape.items()]
        return np.unique(np.fromiter(map(self._of, [*lower, *names]), np.int32))


@dataclass
class Ordinal:
    """Weights, and thresholds in rising order: one fewer than there are grades.

    ``used`` marks the features that enough texts of the sample had; others say nothing.
    """

    weights: np.ndarray
    used: np.ndarray
    thresholds: np.ndarray

    def score(self, found: np.ndarray) -> float:
        """The weights of a text's features, damped by how many there are."""
        found = found[self.used[found]]
        return float(self.weights[found].sum(dtype=np.float64) * _damp(np.array(len(found))))

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) by row, for every threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))


def _damp(counts: np.ndarray) -> np.ndarray:
    return 1 / np.log2(counts + 2)


def fit_ordinal(
    rows: list[np.ndarray], grades: np.ndarray, levels: int, width: int = WIDTH,
    min_rows: int = MIN_ROWS, steps: int = 150, ridge: float = 1e-4, rate: float = 0.2,
) -> Ordinal:
    """Maximum likelihood with a ridge, by Adam over the whole sample.

    Thresholds are kept in order as a first one and the logarithms of the gaps.
    """
    used = np.bincount(np.concatenate([*rows, np.zeros(0, np.int32)]), minlength=width) >= min_rows
    rows = [r[used[r]] for r in rows]
    indices = np.concatenate([*rows, np.zeros(0, np.int32)])
    sizes = np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    damp = _damp(sizes)
    shares = np.clip([(grades <= k).mean() for k in range(levels - 1)], 0.01, 0.99)
    start = np.log(shares / (1 - shares))
    gaps = np.log(np.maximum(np.diff(start), 0.1))
    point = np.concatenate([np.zeros(width), start[:1], gaps])
    mean, square = np.zeros_like(point), np.zeros_like(point)
    at = np.arange(len(grades))

    def thresholds() -> np.ndarray:
        return point[width] + np.concatenate([[0.0], np.cumsum(np.exp(point[width + 1 :]))])

    for step in range(1, steps + 1):
        weights = point[:width]
        scores = np.bincount(owner, weights[indices], len(rows)) * damp
        above = Ordinal(weights, used, thresholds()).tails(scores)
        upto = np.concatenate([np.zeros((len(at), 1)), 1 - above, np.ones((len(at), 1))], 1)
        slope = upto * (1 - upto)
        chance = np.maximum(upto[at, grades + 1] - upto[at, grades], 1e-12) * len(at)
        # Of -log P(grade): by the score, and by either threshold around the grade.
        by_score = (slope[at, grades + 1] - slope[at, grades]) / chance
        edges = (
            np.bincount(grades, slope[at, grades] / chance, levels + 1)
            - np.bincount(grades + 1, slope[at, grades + 1] / chance, levels + 1)
        )[1:levels]
        later = np.cumsum(edges[::-1])[::-1]
        gradient = np.concatenate(
            [
                np.bincount(indices, (by_score * damp)[owner], width) + ridge * weights,
                later[:1],
                later[1:] * np.exp(point[width + 1 :]),
            ]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        point = point - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Ordinal(point[:width].astype(np.float32), used, thresholds())


def grade_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """0 for toxic, 1 for poor, 2 for good; null where a rating is missing."""
    rated = F.col(quality).isNotNull() & F.col(toxic).isNotNull()
    return F.when(rated, F.when(F.col(toxic) == 1, 0).when(F.col(quality) != 1, 1).otherwise(2))


def fit_quality(
    docs: DataFrame, grades: DataFrame, levels: int = 3, sample: int = SAMPLE,
    key: str = "doc_id", text: str = "text",
) -> Ordinal:
    """A model from ``docs`` and their ``grades`` (key and ``grade``).

    Fitted on at most ``sample`` graded keys.  Without any graded text every weight is
    zero and all grades are equally likely.
    """
    wanted = grades.filter(F.col("grade").isNotNull()).select(F.col(key).alias("id"), "grade")
    wanted = stored(wanted.orderBy(F.xxhash64("id"), "id", "grade").limit(sample), "quality-sample")
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(wanted), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [features(x.as_py()).tobytes() for x in batch.column("text")]
            names = [batch.column("grade"), pa.array([xxhash.xxh64_intdigest(x) & 0x7FFFFFFF for x in found], pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(names, ["grade", "mark", "found"])

    taken = rows.mapInArrow(run, "grade int, mark long, found binary").toPandas()
    if taken.empty:
        equal = np.log(np.arange(1, levels) / (levels - np.arange(1, levels)))
        return Ordinal(np.zeros(WIDTH, np.float32), np.zeros(WIDTH, bool), equal)
    # The order of rows must not decide the last digits of a sum.
    taken = taken.sort_values(["mark", "grade"])
    vectors = [np.frombuffer(x, np.int32) for x in taken["found"]]
    return fit_ordinal(vectors, taken["grade"].to_numpy(), levels)


def judge(model: Ordinal) -> Callable[[Column], Column]:
    """A function of a text column: its ``expected_grade`` and ``tail``, P(the highest grade)."""
    parts = model.weights, model.used, model.thresholds

    @F.pandas_udf(_JUDGED)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ordinal = Ordinal(*parts)
        features = Features(len(ordinal.weights))
        for texts in batches:
            scores = [ordinal.score(features(text)) for text in texts]
            tails = ordinal.tails(np.array(scores, np.float64)).round(6)
            yield pd.DataFrame({"expected_grade": tails.sum(1).round(6), "tail": tails[:, -1]})

    return judged


def graded(docs: DataFrame, model: Ordinal, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, expected_grade, tail`` of every row.

    Null and empty texts are judged by the features of an empty text.  Equal texts get
    equal results, so repeated rows do.  Other columns are not read.
    """
    return docs.select(key, judge(model)(F.col(text)).alias("judged")).select(key, "judged.*")


def good_documents(
    docs: DataFrame, grades: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose chance of the highest grade reaches ``threshold``.

    Every row is judged by itself and where it lies; no text is shuffled.
    """
    model = fit_quality(docs, grades, key=key, text=text)
    return docs.where(judge(model)(F.col(text))["tail"] >= threshold)
