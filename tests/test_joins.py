import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from threadtone.operators.joins import (
    dealt,
    both_probabilities,
    labelled_comments,
    looked_up,
    with_flags,
    with_submissions,
)

COMMENT = "id string, body string, link_id string, created_utc bigint, score bigint, author_flair_text string"

from threadtone.operators.share import share_by_submission


def comments(spark):
    return spark.createDataFrame(
        [
            ("c1", "one", "t3_s1", 10, 1, "Ohio"),
            ("c2", "two", "t3_s2", 20, 2, None),
            ("c3", None, "t3_s1", 30, 3, "Utah"),
            ("c4", "four", None, 40, 4, "Utah"),
            ("c5", "five", "t3_gone", 50, 5, "Utah"),
        ],
        COMMENT,
    )


def test_labels_beyond_the_limit_go_in_blocks(spark):
    labeled = spark.createDataFrame([(f"c{i % 700}", str(i % 3), "x") for i in range(1000)], "Input_id string, a string, b string")
    bodies = spark.createDataFrame([(f"c{i}", f"text {i}") for i in range(900)], "id string, body string")
    whole = labelled_comments(labeled, bodies, ["a", "b"])
    cut = labelled_comments(labeled, bodies, ["a", "b"], most=100)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
    plan = plan_of(cut)
    assert plan.count("BroadcastHashJoin") >= 10 and "SortMergeJoin" not in plan
    # The only exchanges are broadcasts: no body is shuffled.
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    # Equal rows cannot be parted; then both sides are shuffled.
    equal = spark.createDataFrame([("c1", "1", "x")] * 50, "Input_id string, a string, b string")
    found = labelled_comments(equal, bodies, ["a", "b"], most=10)
    assert found.count() == 50 and "SortMergeJoin" in plan_of(found)


def test_labelled_comments(spark):
    labeled = spark.createDataFrame(
        [("c1", "1", "x"), ("c1", "0", "y"), ("c9", "1", "z"), (None, "1", "n")],
        "Input_id string, labeldjt string, other string",
    )
    rows = labelled_comments(labeled, comments(spark), ["labeldjt"]).collect()
    assert sorted(map(tuple, rows)) == [("c1", "0", "one"), ("c1", "1", "one")]


def test_labels_are_broadcast_up_to_a_limit(spark):
    labeled = spark.createDataFrame([("c1", "1")], "Input_id string, labeldjt string")
    few = plan_of(labelled_comments(labeled, comments(spark), ["labeldjt"]))
    assert "BroadcastHashJoin" in few and "Exchange hashpartitioning" not in few
    many = labelled_comments(labeled, comments(spark), ["labeldjt"], most=0)
    assert "SortMergeJoin" in plan_of(many)
    assert [tuple(r) for r in many.collect()] == [("c1", "1", "one")]


def test_hot_submission_is_summed_before_the_join(spark, skew_settings):
    rows = spark.range(0, 50_000, 1, 8).select(
        F.when(F.col("id") % 5 > 0, "t3_hot").otherwise(F.concat(F.lit("t3_"), "id")).alias("link_id"),
        (F.col("id") % 2).cast("int").alias("p"),
    )
    submissions = spark.range(0, 50_000, 5).select(F.col("id").cast("string").alias("id"))
    submissions = submissions.unionAll(spark.createDataFrame([("hot",), ("hot",), ("none",)], "id string"))
    shares = share_by_submission(rows, submissions, {"s": "p"})
    plan = plan_of(shares)
    assert plan.index("SortMergeJoin") < plan.index("partial_sum")
    got = {r.link_id: r.s for r in shares.collect()}
    assert len(got) == 10_001 and got["hot"] == 0.5 and shares.count() == 10_001


def test_with_submissions(spark):
    submissions = spark.createDataFrame([("s1", 100), ("s2", 200)], "id string, score bigint")
    rows = with_submissions(comments(spark), submissions, carry=["body"]).collect()
    assert sorted(map(tuple, rows), key=lambda r: r[0]) == [
        (10, 1, 100, "s1", "Ohio", "c1", "one"),
        (20, 2, 200, "s2", None, "c2", "two"),
        (30, 3, 100, "s1", "Utah", "c3", None),
    ]


def test_repeated_submission_ids_multiply(spark):
    submissions = spark.createDataFrame([("s1", 1), ("s1", 2)], "id string, score bigint")
    assert with_submissions(comments(spark), submissions).count() == 4


def test_submission_key_stays_in_the_jvm(spark):
    submissions = spark.createDataFrame([("s1", 100)], "id string, score bigint")
    assert "Python" not in plan_of(with_submissions(comments(spark), submissions))


@pytest.fixture
def skew_settings(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_hot_submission_is_split_over_tasks(spark, skew_settings):
    # A third of all comments belong to one submission.
    rows = spark.range(0, 60_000, 1, 8).select(
        F.concat(F.lit("c"), "id").alias("id"),
        F.md5(F.col("id").cast("string")).alias("body"),
        F.when(F.col("id") % 3 == 0, "t3_hot")
        .otherwise(F.concat(F.lit("t3_"), F.col("id")))
        .alias("link_id"),
        F.col("id").alias("created_utc"),
        F.col("id").alias("score"),
        F.lit("Ohio").alias("author_flair_text"),
    )
    submissions = (
        spark.range(0, 60_000).where("id % 3 <> 0")
        .select(F.col("id").cast("string").alias("id"), F.col("id").alias("score"))
        .unionAll(spark.createDataFrame([("hot", 1)], "id string, score bigint"))
    )
    joined = with_submissions(rows, submissions, carry=["body"])
    assert len(joined.collect()) == 60_000
    plan = plan_of(joined)
    assert "SortMergeJoin(skew=true)" in plan, plan


def test_with_flags(spark):
    metadata = spark.createDataFrame([("c1", 5), ("c2", 6)], "comment_id string, c_score int")
    flags = spark.createDataFrame([("c1", 1, 0), ("c3", 1, 1)], "id string, p int, n int")
    joined = with_flags(metadata, flags)
    assert joined.columns == ["comment_id", "c_score", "p", "n"]
    assert [tuple(r) for r in joined.collect()] == [("c1", 5, 1, 0)]


def test_both_probabilities(spark):
    positive = spark.createDataFrame([("a", 0.1), ("b", 0.2)], "id string, probability double")
    negative = spark.createDataFrame([("b", 0.7), ("c", 0.2)], "id string, probability double")
    assert [tuple(r) for r in both_probabilities(positive, negative).collect()] == [
        ("b", 0.2, 0.7)
    ]


def test_lookup(spark):
    dimension = spark.createDataFrame([("Ohio",), ("Utah",)], "state string")
    facts = spark.createDataFrame([("Ohio", 0.5)], "state string, v double")
    found = looked_up(dimension, facts, "state", "v", missing="null")
    assert sorted(map(tuple, found.collect())) == [("Ohio", 0.5), ("Utah", None)]
    with pytest.raises(Exception, match="no fact for Utah"):
        looked_up(dimension, facts, "state", "v").collect()
    with pytest.raises(ValueError):
        looked_up(dimension, facts, "state", "v", missing="ignore")


def test_tasks_of_labelled_text_do_not_grow(spark):
    """However many rows the join leaves, a task gets as many as fit and no more."""
    comments = spark.range(0, 9000, 1, 2).select(F.col("id"), F.lit("a b").alias("body"))
    labeled = comments.select(F.col("id").alias("Input_id"), F.lit("1").alias("l"))
    rows = dealt(labelled_comments(labeled, comments, ["l"]), per_task=500)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 9000 and len(sizes) == 18 and max(sizes) <= 520
    assert dealt(comments.limit(0)).count() == 0
