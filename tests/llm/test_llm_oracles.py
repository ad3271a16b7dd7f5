"""The operators' queries against SQL on the given tables."""

import duckdb
import pytest

from threadtone.llm.queries import QUERIES
from threadtone.llm.sql import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, testdata, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{testdata}/{table}.parquet'")
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    df = QUERIES[name](spark, testdata)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(result.fetchall(), key=repr)
