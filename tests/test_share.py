from pyspark.sql import functions as F

from tests.conftest import plan_of
from threadtone.functions.scalars import in_states
from threadtone.operators.share import share, share_by_target
from threadtone.plans.publishing import share_tables

SENTIMENT = (
    "timestamp bigint, link_id string, comment_id string, state string, "
    "a_pos int, a_neg int, b_pos int, b_neg int, c_score bigint, s_score bigint"
)
DAY = 86400
ROWS = [
    (0, "l1", "c1", "Ohio", 1, 0, 0, 0, 5, 50),
    (1, "l1", "c2", "Ohio", 0, 1, 0, 1, 5, 50),
    (DAY, "l2", "c3", "Utah", 1, 1, 1, 1, 7, 60),
    (DAY, "l2", "c4", None, 1, 0, 1, 0, 7, 60),
    (None, "l2", "c5", "Narnia", 0, 0, 1, 0, 8, 60),
]


def sentiment(spark):
    return spark.createDataFrame(ROWS, SENTIMENT)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_share(spark):
    flags = {"Positive": "a_pos", "Negative": "a_neg"}
    got = share(sentiment(spark), "link_id", flags)
    assert got.columns == ["link_id", "Positive", "Negative"]
    assert rows(got) == [("l1", 0.5, 0.5), ("l2", 2 / 3, 1 / 3)]


def test_share_with_filter(spark):
    got = share(
        sentiment(spark), "state", {"p": "a_pos"}, in_states(F.col("state"))
    )
    assert rows(got) == [("Ohio", 0.5), ("Utah", 1.0)]


def test_share_by_target_equals_one_share_per_target(spark):
    df = sentiment(spark)
    both = share_by_target(df, "c_score", "comment_score", ["a", "b"])
    single = [
        (t, *r)
        for t in "ab"
        for r in share(df, "c_score", {"p": f"{t}_pos", "n": f"{t}_neg"}).collect()
    ]
    assert rows(both) == sorted(single, key=repr)
    assert both.columns == ["target", "comment_score", "Positive", "Negative"]


def test_share_tables_filters(spark):
    tables = share_tables(sentiment(spark), ["a"])
    # Days count every row, also those without a valid state.
    assert rows(tables["day"].withColumn("date", F.col("date").cast("string"))) == [
        ("a", "1970-01-01", 0.5, 0.5),
        ("a", "1970-01-02", 1.0, 0.5),
        ("a", None, 0.0, 0.0),
    ]
    assert set(tables) == {"day", "state", "comment_score", "submission_score"}
    assert rows(tables["state"]) == [("a", "Ohio", 0.5, 0.5), ("a", "Utah", 1.0, 1.0)]
    assert rows(tables["comment_score"]) == [("a", 5, 0.5, 0.5), ("a", 7, 1.0, 1.0)]
    assert rows(tables["submission_score"]) == [("a", 50, 0.5, 0.5), ("a", 60, 1.0, 1.0)]


def test_rows_are_aggregated_before_the_shuffle(spark):
    plan = plan_of(share_tables(sentiment(spark), ["a", "b"])["day"])
    exchange = plan.index("Exchange hashpartitioning")
    assert "partial_sum" in plan[exchange:]
    assert plan.count("Exchange") == 1
    # The result is unfolded by target after the aggregation.
    assert plan.index("Generate") < exchange


def test_state_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "sentiment")
    sentiment(spark).write.parquet(path)
    tables = share_tables(spark.read.parquet(path), ["a"], ["Ohio", "Utah"])
    plan = plan_of(tables["state"])
    assert "In(state, [Ohio,Utah])" in plan
    assert "ReadSchema: struct<state:string,a_pos:int,a_neg:int>" in plan


def test_hot_key_costs_one_row_per_task(spark):
    # A third of the rows share a key; what is shuffled is one row per task and key.
    df = spark.range(0, 90_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") % 2).cast("int").alias("p"),
    )
    got = {r.k: r.s for r in share(df, "k", {"s": "p"}).collect()}
    assert len(got) == 51 and got[-1] == 0.5
