import pytest
from pyspark.ml.feature import CountVectorizer

from tests.conftest import plan_of
from threadtone.functions.text import with_grams
from threadtone.operators import vocabulary
from threadtone.operators.vocabulary import (
    fit_vocabulary,
    most_frequent,
    term_statistics,
    vector_terms,
)


def docs(spark, lists):
    return spark.createDataFrame(list(enumerate(lists)), "id int, grams array<string>")


def test_statistics(spark):
    df = docs(spark, [["b", "a", "a"], ["a", "", ""], ["b", "", "c"], []])
    got = {tuple(r) for r in term_statistics(df, min_df=1).collect()}
    assert got == {("a", 2, 3), ("b", 2, 2), ("", 2, 3), ("c", 1, 1)}
    got = {r.term for r in term_statistics(df, min_df=2).collect()}
    assert got == {"a", "b", ""}


def test_most_frequent_with_ties(spark):
    df = docs(spark, [["a"] * 3, ["b"] * 2, ["c"] * 2, ["d"] * 2, ["e"]])
    stats = term_statistics(df, min_df=1)
    for size, expected in [(1, "a"), (2, "ab"), (3, "abc"), (4, "abcd"), (5, "abcde"), (9, "abcde")]:
        assert [r.term for r in most_frequent(stats, size).collect()] == list(expected)


def test_no_window_gathers_all_counts(spark):
    stats = term_statistics(docs(spark, [["a", "b", "b"]]), min_df=1)
    assert "Window" not in plan_of(most_frequent(stats, 1))


def test_large_counts_fall_into_classes(spark):
    rows = [(f"t{i:03}", 1, 1 + i * i) for i in range(300)]
    stats = spark.createDataFrame(rows, "term string, document_frequency int, total_count long")
    for size in (1, 7, 150, 299, 300, 400):
        got = [r.term for r in most_frequent(stats, size).collect()]
        assert got == [f"t{i:03}" for i in reversed(range(300))][:size]


def test_long_vocabularies_are_not_left_to_the_optimizer(spark, monkeypatch):
    monkeypatch.setattr(vocabulary, "BROADCAST_CHARACTERS", 0)
    df = docs(spark, [["a", "b"], ["a"]])
    model = fit_vocabulary(df, min_df=1)
    terms = vector_terms(model.transform(df), model, ["id"])
    assert "SortMergeJoin" in plan_of(terms)
    assert {tuple(r) for r in terms.collect()} == {(0, "a"), (0, "b"), (1, "a")}


def test_limit_cuts_by_total_count(spark):
    df = docs(spark, [["x", "x", "x", "y"], ["y", "z"], ["z"], ["y"]])
    model = fit_vocabulary(df, min_df=1, size=2)
    assert set(model.vocabulary) == {"x", "y"}


def test_same_vocabulary_as_count_vectorizer(spark, testdata):
    bodies = spark.read.parquet(f"{testdata}/documents.parquet").selectExpr(
        "doc_id AS id", "text AS body"
    )
    grams = with_grams(bodies).persist()
    ours = fit_vocabulary(grams)
    theirs = CountVectorizer(
        inputCol="grams", outputCol="vectorized", minDF=5.0, binary=True
    ).fit(grams)
    assert set(ours.vocabulary) == set(theirs.vocabulary)
    assert fit_vocabulary(grams.repartition(7)).vocabulary == ours.vocabulary
    counts = [
        {r.id: r.vectorized.numNonzeros() for r in m.transform(grams).collect()}
        for m in (ours, theirs)
    ]
    assert counts[0] == counts[1]
    grams.unpersist()


def test_vectors_are_binary_and_keep_the_empty_gram(spark):
    df = docs(spark, [["a", "a", ""], ["a", "b", "", ""]])
    model = fit_vocabulary(df, min_df=2)
    assert sorted(model.vocabulary) == ["", "a"]
    vectors = model.transform(df)
    assert all(set(r.vectorized.values) == {1.0} for r in vectors.collect())
    terms = {tuple(r) for r in vector_terms(vectors, model, ["id"]).collect()}
    assert terms == {(0, ""), (0, "a"), (1, ""), (1, "a")}


def test_empty_vocabulary_is_an_error(spark):
    with pytest.raises(ValueError, match="no term"):
        fit_vocabulary(docs(spark, [["a"], ["b"]]))
