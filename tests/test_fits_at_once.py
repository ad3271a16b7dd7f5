"""Fits that share their passes, against Spark's own regression fitted one by one."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadtone.operators import solver
from threadtone.operators.classifier import cross_validate
from threadtone.operators.solver import Fit, fitted
from threadtone.session import fresh_path
from threadtone.sources.filesystem import stored_files


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(4)
    x = (draw.random((300, 40)) < draw.uniform(0.02, 0.5, 40)).astype(float)
    x[:, 7], x[:, 9], x[5], x[:, 11] = 1.0, 0.0, 0.0, draw.normal(size=300)
    y = (x @ draw.normal(size=40) + draw.normal(size=300) > 1).astype(float)
    sparse = [Vectors.sparse(40, {int(k): float(a[k]) for k in np.nonzero(a)[0]}) for a in x]
    data = [(float(b), i % 3, Vectors.dense(a) if i % 2 else s) for i, (a, b, s) in enumerate(zip(x, y, sparse))]
    return spark.createDataFrame(data, ["label", "fold", "vectorized"]).repartition(4).cache()


def test_every_fit_is_that_of_sparks_regression(rows):
    fits = [Fit(1.0, 0), Fit(0.05, 2), Fit(1.0)]
    found = fitted(rows, "label", "vectorized", fits, 10, "fold", block=16)
    for fit, (weights, intercept) in zip(fits, found):
        own = rows if fit.left_out is None else rows.where(F.col("fold") != fit.left_out)
        model = LogisticRegression(featuresCol="vectorized", maxIter=10, regParam=fit.penalty).fit(own)
        assert np.abs(model.coefficients.toArray() - weights).max() < 1e-8
        assert abs(model.intercept - intercept) < 1e-8


def test_no_fit_brings_its_gradients_to_the_driver(rows, monkeypatch):
    """Spark's regression does, a gradient as long as the vocabulary a pass."""

    def fit(self, dataset):
        raise AssertionError("a fit of Spark's")

    monkeypatch.setattr(LogisticRegression, "_fit", fit)
    found = cross_validate(rows, "label", folds=3, fold="fold")
    assert len(found.avgMetrics) == 1 and 0.8 < found.avgMetrics[0] <= 1
    assert found.bestModel.numFeatures == 40 and found.bestModel.getRegParam() == 1.0


def test_one_label_alone(rows):
    alone = rows.where("label = 1")
    assert fitted(alone, "label", "vectorized", [Fit(1.0)], 10) == [None]
    model = cross_validate(alone, "label", folds=3, fold="fold").bestModel
    assert model.intercept == np.inf and not model.coefficients.toArray().any()


def test_rows_are_read_a_little_at_a_time(spark, rows, monkeypatch):
    """What a task holds must not go with the rows of its files."""
    folder = fresh_path(spark, "rows")
    solver.store_rows(rows.coalesce(1), "vectorized", ["label", "fold"], folder)
    monkeypatch.setattr(solver, "ENTRIES", 100)
    (path,) = stored_files(folder, ".parquet")
    found, seen = list(solver._bunches([path], folder, "label", "fold")), []
    for y, folds, sizes, at, values in found:
        assert len(y) == len(folds) == len(sizes) and len(at) == sizes.sum() and len(values) in (0, len(at))
        assert len(at) <= 100 or len(y) == 1
        ends = np.cumsum(sizes)
        values = values if len(values) else np.ones(len(at))
        for i, (a, b) in enumerate(zip(ends - sizes, ends)):
            seen.append((y[i], int(folds[i]), {int(k): v for k, v in zip(at[a:b], values[a:b]) if v}))
    given = [(r.label, r.fold, {i: v for i, v in enumerate(r.vectorized.toArray()) if v}) for r in rows.collect()]
    order = lambda r: (r[0], r[1], sorted(r[2].items()))
    assert len(found) > 20 and sorted(seen, key=order) == sorted(given, key=order)


def test_no_row_of_a_fit_stays_in_a_heap(rows, monkeypatch):
    """Cached, the rows of every model would be large arrays in the executors' heaps."""
    fits = [Fit(1.0, 0), Fit(1.0)]
    expected = fitted(rows, "label", "vectorized", fits, 2, "fold")

    def cached(self, *level):
        raise AssertionError("rows are cached")

    monkeypatch.setattr(DataFrame, "persist", cached)
    monkeypatch.setattr(DataFrame, "cache", cached)
    found = fitted(rows, "label", "vectorized", fits, 2, "fold")
    for (a, b), (c, d) in zip(expected, found):
        assert np.abs(a - c).max() < 1e-12 and abs(b - d) < 1e-12


def test_labels_share_what_is_stored(spark, rows):
    both = rows.withColumn("other", (F.col("label") + F.col("fold")) % 2)
    folder = fresh_path(spark, "rows")
    solver.store_rows(both, "vectorized", ["label", "other", "fold"], folder)
    (own,) = fitted(both, "other", "vectorized", [Fit(1.0, 1)], 5, "fold")
    (shared,) = fitted(both, "other", "vectorized", [Fit(1.0, 1)], 5, "fold", stored=folder)
    assert np.abs(own[0] - shared[0]).max() < 1e-12 and abs(own[1] - shared[1]) < 1e-12
    assert len(stored_files(folder, ".parquet")) == 4
