"""Every registered query against SQL on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from threadtone.workload.oracles import ORACLES
from threadtone.workload.queries import registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
ROWS_ONLY = {
    "bernoulli_sample", "model_cv_auc", "model_holdout_auc", "model_flags",
    "scored_share_by_day",
}


@pytest.fixture(scope="module")
def duck(testdata_folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{testdata_folder}/{name}.parquet'"
        )
    return connection


@pytest.fixture(scope="module")
def testdata_folder():
    return "/root/testdata/sf0.001"


def comparable(rows):
    return sorted(
        (
            tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row)
            for row in rows
        ),
        key=repr,
    )


def test_every_query_has_sql_or_is_known_to_have_none():
    assert set(ORACLES) | ROWS_ONLY == set(registered())
    assert not set(ORACLES) & ROWS_ONLY
    assert set(registered()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, testdata_folder, name):
    df = contract.queries()[name](spark, testdata_folder)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    got = comparable(map(tuple, df.select(*columns).collect()))
    assert got == comparable(expected)
    assert got


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["target", "date", "Positive", "Negative"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["bernoulli_sample", "random_split"])
def test_random_queries_repeat(spark, testdata_folder, name):
    query = contract.queries()[name]
    runs = [sorted(map(tuple, query(spark, testdata_folder).collect())) for _ in range(2)]
    assert runs[0] == runs[1] and runs[0]


def test_model_queries(spark, testdata_folder):
    queries = contract.queries()
    auc = queries["model_cv_auc"](spark, testdata_folder).collect()
    assert len(auc) == 6 and all(0 <= r.cv_auc <= 1 for r in auc)
    held = queries["model_holdout_auc"](spark, testdata_folder).collect()
    assert len(held) == 6 and all(0 <= r.holdout_auc <= 1 for r in held)
    flags = queries["model_flags"](spark, testdata_folder).collect()
    assert flags and {v for r in flags for v in r[1:]} <= {0, 1}
    shares = queries["scored_share_by_day"](spark, testdata_folder).collect()
    assert shares and all(0 <= r.Positive <= 1 and 0 <= r.Negative <= 1 for r in shares)
