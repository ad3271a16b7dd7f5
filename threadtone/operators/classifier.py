"""Binary classifiers: cross validation, scoring, evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import inheritable_thread_target

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadtone.constants import (
    FOLDS,
    MAX_ITERATIONS,
    NEGATIVE_THRESHOLD,
    POSITIVE_THRESHOLD,
    REGULARISATION_GRID,
)
from threadtone.operators.solver import Fit, fitted


@dataclass(frozen=True)
class Target:
    """Something comments have a sentiment about: its name and its label column."""

    name: str
    label: str
    positive_threshold: float = POSITIVE_THRESHOLD
    negative_threshold: float = NEGATIVE_THRESHOLD


# The three targets of the labelled comment file.
TARGETS = (
    Target("djt", "labeldjt"),
    Target("dem", "labeldem"),
    Target("gop", "labelgop"),
)

POSITIVE, NEGATIVE = "pos", "neg"


class _FoldsAtOnce(CrossValidator):
    """Cross validation of logistic regressions, all fits of which share each pass.

    Gradients stay off the driver; it gets the weights of every model once.  Folds,
    measures and the choice are those of ``CrossValidator``.
    """

    stored: str | None = None  # as for ``fitted``, with a fold column only

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        regression, measure, grid = self.getEstimator(), self.getEvaluator(), self.getEstimatorParamMaps()
        numbers, fold, source = range(self.getNumFolds()), self.getFoldCol(), dataset
        stored = self.stored if fold else None
        if not fold:
            fold, drawn = f"{self.uid}_fold", f"{self.uid}_rand"
            share = 1.0 / len(numbers)
            source = dataset.select("*", F.rand(self.getSeed()).alias(drawn))
            number = sum(((F.col(drawn) >= i * share).cast("int") for i in numbers[1:]), F.lit(0))
            source = source.withColumn(fold, number)
        folds = self.copy({self.foldCol: fold})._kFold(source)
        label, features = regression.getLabelCol(), regression.getFeaturesCol()
        penalties = [params.get(regression.regParam, regression.getRegParam()) for params in grid]
        parts = [(i, j) for i in (*numbers, None) for j in range(len(grid))]
        found = fitted(
            source, label, features, [Fit(penalties[j], i) for i, j in parts], regression.getMaxIter(), fold,
            stored=stored,
        )

        def model(i: int | None, j: int) -> LogisticRegressionModel:
            own, solution = regression.copy(grid[j]), found[parts.index((i, j))]
            if solution is None:  # one label alone, which takes no pass
                return own.fit(dataset if i is None else folds[i][0])
            weights, intercept = solution
            made = JavaWrapper._new_java_obj(
                "org.apache.spark.ml.classification.LogisticRegressionModel",
                own.uid, Vectors.dense(weights), intercept,
            )
            return own._copyValues(LogisticRegressionModel(made))

        def measured(part: tuple[int, int]) -> float:
            return measure.evaluate(model(*part).transform(folds[part[0]][1]))

        held = parts[: len(numbers) * len(grid)]
        with ThreadPoolExecutor(max(1, self.getParallelism())) as pool:
            values = list(pool.map(inheritable_thread_target(dataset.sparkSession)(measured), held))
        means, deviations = self._gen_avg_and_std_metrics(np.reshape(values, (len(numbers), len(grid))).tolist())
        best = int(np.argmax(means))
        return self._copyValues(CrossValidatorModel(model(None, best), means, None, deviations))


def cross_validate(
    train: DataFrame,
    label: str,
    features: str = "vectorized",
    seed: int = 0,
    folds: int = FOLDS,
    grid: Sequence[float] = REGULARISATION_GRID,
    max_iter: int = MAX_ITERATIONS,
    parallelism: int = 2,
    fold: str | None = None,
    stored: str | None = None,
) -> CrossValidatorModel:
    """Logistic regression, its regularisation chosen by AUC over the folds.

    ``fold`` names a column with each row's fold, from 0; then the folds do not depend
    on how the rows lie.  Without it Spark draws them by ``seed`` and partition.  Several
    labels of the same rows may share what ``solver.store_rows`` has ``stored``.
    """
    regression = LogisticRegression(
        labelCol=label, featuresCol=features, maxIter=max_iter
    )
    validator = _FoldsAtOnce(
        estimator=regression,
        evaluator=BinaryClassificationEvaluator(labelCol=label),
        estimatorParamMaps=ParamGridBuilder()
        .addGrid(regression.regParam, list(grid))
        .build(),
        numFolds=folds,
        **({"foldCol": fold} if fold else {}),
        seed=seed,
        parallelism=parallelism,
    )
    validator.stored = stored
    return validator.fit(train)


def holdout_auc(
    model: CrossValidatorModel | LogisticRegressionModel, test: DataFrame, label: str
) -> float:
    """Area under ROC on rows the model has not seen."""
    scored = model.transform(test)
    return BinaryClassificationEvaluator(labelCol=label).evaluate(scored)


def add_probability(
    df: DataFrame,
    model: CrossValidatorModel | LogisticRegressionModel,
    output: str,
    features: str = "vectorized",
) -> DataFrame:
    """Append the model's probability vector and nothing else."""
    best = getattr(model, "bestModel", model)
    quiet = best.copy(
        {
            best.featuresCol: features,
            best.probabilityCol: output,
            best.rawPredictionCol: "",
            best.predictionCol: "",
        }
    )
    return quiet.transform(df)
