"""The library's regression against a solver of its own: Newton steps in numpy."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from threadtone.constants import MAX_ITERATIONS
from threadtone.operators.classifier import cross_validate


def objective(x, y, weights, intercept, penalty):
    """Mean log loss with half the penalty on weights in units of their columns' spread."""
    scale = x.std(0, ddof=1)
    z = x @ weights + intercept
    return np.logaddexp(0, np.where(y == 1, -z, z)).mean() + penalty / 2 * ((weights * scale) ** 2).sum()


def gradient(x, y, weights, intercept, penalty):
    """By the weights in those units, and by the intercept."""
    scale = x.std(0, ddof=1)
    off = 1 / (1 + np.exp(-(x @ weights + intercept))) - y
    inner = np.divide(x, scale, out=np.zeros_like(x), where=scale > 0)
    return np.append(inner.T @ off / len(y) + penalty * weights * scale, off.mean())


def newton(x, y, penalty, steps=60):
    scale = x.std(0, ddof=1)
    inner = np.divide(x, scale, out=np.zeros_like(x), where=scale > 0)
    full = np.hstack([inner, np.ones((len(y), 1))])
    ridge = np.diag([penalty] * x.shape[1] + [0.0])
    point = np.zeros(full.shape[1])
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-(full @ point)))
        slope = full.T @ (chance - y) / len(y) + ridge @ point
        curve = (full * (chance * (1 - chance))[:, None]).T @ full / len(y) + ridge
        point = point - np.linalg.solve(curve + 1e-12 * np.eye(len(point)), slope)
    return np.divide(point[:-1], scale, out=np.zeros(x.shape[1]), where=scale > 0), point[-1]


@pytest.fixture(scope="module")
def sample(spark):
    draw = np.random.default_rng(8)
    x = (draw.random((400, 30)) < draw.uniform(0.03, 0.6, 30)).astype(float)
    x[:, 7] = 1.0  # no spread, no weight
    y = (x @ draw.normal(size=30) + draw.normal(size=400) > 0.5).astype(float)
    rows = [(float(b), Vectors.dense(a)) for a, b in zip(x, y)]
    return x, y, spark.createDataFrame(rows, ["label", "vectorized"]).cache()


@pytest.mark.parametrize("penalty", [1.0, 0.05])
def test_coefficients_at_convergence(sample, penalty):
    x, y, df = sample
    model = LogisticRegression(featuresCol="vectorized", maxIter=500, tol=1e-12, regParam=penalty).fit(df)
    weights, intercept = newton(x, y, penalty)
    assert np.abs(model.coefficients.toArray() - weights).max() < 1e-3
    assert abs(model.intercept - intercept) < 1e-3
    assert np.abs(gradient(x, y, weights, intercept, penalty)).max() < 1e-9


def test_what_ten_iterations_leave(sample):
    """The library's setting stops early; here is how far from the optimum."""
    x, y, df = sample
    found = cross_validate(df, "label", folds=2).bestModel
    assert found.getMaxIter() == MAX_ITERATIONS == 10
    slope = np.abs(gradient(x, y, found.coefficients.toArray(), found.intercept, 1.0)).max()
    best = objective(x, y, *newton(x, y, 1.0), 1.0)
    over = objective(x, y, found.coefficients.toArray(), found.intercept, 1.0) - best
    print(f"gradient {slope:.2e}, above the optimum {over:.2e}")
    assert slope < 1e-3 and 0 <= over + 1e-12 < 1e-5
