from math import exp

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from threadtone.operators.coefficients import probabilities

TABLE = [("f", None, 0.5), ("f", "a", 1.0), ("f", "b", -2.0), ("g", "b", 3.0), ("g", "c", 0.25)]


def chance(x):
    return pytest.approx(1 / (1 + exp(-x)))


@pytest.mark.parametrize("most", [1, 3, 1 << 20])
def test_rows_of_a_key_are_one_text(spark, most):
    rows = [(1, ["a", "b", "b"]), (2, ["a"]), (2, ["a", "c"]), (3, []), (4, None), (5, ["x"])]
    rows += [(None, ["b"]), (None, ["b", "a"])]
    texts = spark.createDataFrame(rows, "id long, grams array<string>").repartition(3)
    table = spark.createDataFrame(TABLE, "flag string, term string, weight double")
    found = {r.id: (r.f, r.g) for r in probabilities(texts, table, ["f", "g"], most=most).collect()}
    assert found == {
        1: (chance(-0.5), chance(3)), 2: (chance(1.5), chance(0.25)), 3: (chance(0.5), chance(0)),
        4: (chance(0.5), chance(0)), 5: (chance(0.5), chance(0)), None: (chance(-0.5), chance(3)),
    }


def test_no_term_is_shuffled(spark):
    grams = F.transform(F.sequence(F.lit(1), F.lit(50)), lambda i: F.concat(F.lit("t"), (F.col("id") * 50 + i).cast("string")))
    texts = spark.range(200).select("id", grams.alias("grams"))
    table = texts.select(F.lit("f").alias("flag"), F.explode("grams").alias("term"), F.lit(0.1).alias("weight"))
    found = probabilities(texts, table, ["f"])
    assert found.count() == 200
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert not any("Exchange hashpartitioning" in line and "__term" in line for line in plan.splitlines())
