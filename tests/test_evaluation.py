import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tests.conftest import plan_of
from threadtone.operators.evaluation import area_under_roc


def brute(rows):
    rows = [(s, y) for s, y in rows if s is not None and y is not None]
    above = [s for s, y in rows if y == 1]
    below = [s for s, y in rows if y != 1]
    if not above or not below:
        return None
    won = sum((a > b) + (a == b) / 2 for a in above for b in below)
    return won / len(above) / len(below)


def test_ties_groups_and_nulls(spark):
    draw = random.Random(2)
    rows = [(draw.choice("ab"), float(draw.randrange(12)), draw.randrange(2)) for _ in range(400)]
    rows += [("a", None, 1), ("b", 3.0, None), ("only", 1.0, 1), (None, 2.0, 0), (None, 5.0, 1), (None, 2.0, 1)]
    df = spark.createDataFrame(rows, "g string, s double, y int").repartition(5)
    got = {r.g: r for r in area_under_roc(df, "s", "y", ["g"]).collect()}
    assert set(got) == {"a", "b", "only", None}
    for g, r in got.items():
        expect = brute([(s, y) for h, s, y in rows if h == g])
        assert r.auc == (None if expect is None else pytest.approx(expect, abs=1e-12))
    assert (got["only"].positives, got["only"].negatives) == (1, 0)


def test_equals_the_evaluator(spark):
    draw = random.Random(5)
    # Adding zero leaves no -0.0, which the evaluator may tell from 0.0.
    rows = [(round(draw.gauss(y, 1.5), 2) + 0.0, y) for y in (draw.randrange(2) for _ in range(3000))]
    df = spark.createDataFrame(rows, "s double, y int")
    vectors = df.select(F.col("y").cast("double").alias("label"), array_to_vector(F.array(-F.col("s"), F.col("s"))).alias("rawPrediction"))
    expect = BinaryClassificationEvaluator(numBins=0).evaluate(vectors)
    assert area_under_roc(df, "s", "y").first().auc == pytest.approx(expect, abs=1e-9)


def test_empty(spark):
    none = spark.createDataFrame([], "s double, y int")
    assert [r.auc for r in area_under_roc(none, "s", "y").collect()] in ([], [None])


def test_no_task_sees_all_scores(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("s"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    areas = area_under_roc(df, "s", "y")
    areas.collect()
    windows = [line for line in plan_of(areas).splitlines() if "Window [" in line]
    assert windows and any("stretch" in line for line in windows)
    # What goes to one partition is a row for each stretch.
    assert "SinglePartition" not in plan_of(areas).split("Window [")[0] or areas.count() == 1
