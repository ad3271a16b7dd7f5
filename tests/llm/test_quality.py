import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from threadtone.llm.quality import Features, Ordinal, fit_ordinal, fit_quality, good_documents, grade_of, graded


@pytest.fixture(scope="module")
def rated():
    """Texts and grades of the mid-sized given table, in a fixed order."""
    folder = "/root/testdata/sf0.1"
    rows = duckdb.sql(
        f"SELECT d.doc_id, text, CASE WHEN toxic = 1 THEN 0 WHEN quality <> 1 THEN 1 ELSE 2 END AS grade "
        f"FROM '{folder}/labels.parquet' JOIN '{folder}/documents.parquet' d USING (doc_id) ORDER BY hash(d.doc_id)"
    ).fetchall()
    features = Features()
    return [features(t) for _, t, _ in rows], np.array([g for *_, g in rows])


def test_held_out_accuracy(rated):
    rows, grades = rated
    model = fit_ordinal(rows[:2500], grades[:2500], 3)
    tails = model.tails(np.array([model.score(r) for r in rows[2500:]]))
    kept, truth = tails[:, -1] >= 0.6, grades[2500:]
    assert kept[truth == 2].mean() > 0.97
    assert kept[truth == 1].mean() < 0.12
    # A part of the toxic ratings is noise: nothing in the text shows them.
    assert kept[truth == 0].mean() < 0.45
    expected = tails.sum(1)
    assert expected[truth == 2].mean() > expected[truth == 1].mean() > expected[truth == 0].mean()
    assert (np.diff(model.thresholds) > 0).all()
    assert (tails[:, 0] >= tails[:, 1]).all()


def test_gradient_finds_the_maximum():
    """One feature and many rows: the chances of the grades become their shares."""
    pick = np.random.default_rng(0)
    grades = np.concatenate([pick.choice(3, 4000, p=(0.6, 0.3, 0.1)), pick.choice(3, 4000, p=(0.1, 0.3, 0.6))])
    rows = [np.array([1], np.int32)] * 4000 + [np.array([2], np.int32)] * 4000
    model = fit_ordinal(rows, grades, 3, width=4, steps=600, ridge=0, rate=0.05)
    tails = model.tails(np.array([model.score(rows[0]), model.score(rows[-1])]))
    assert np.allclose(tails, [[0.4, 0.1], [0.9, 0.6]], atol=0.04)


def test_features_are_a_set_and_see_no_case_but_shape():
    features = Features()
    assert len(features("a b a b")) == len(set(features("a b a b").tolist()))
    assert len(features(None)) == len(features("")) > 0
    assert set(features("Clown")) & set(features("clown"))


def test_odd_rows(spark, odd_docs, no_docs):
    grades = spark.createDataFrame([(k, g) for k in range(1, 10) for g in (k % 3, None)], "doc_id long, grade int")
    model = fit_quality(odd_docs, grades)
    found = graded(odd_docs, model)
    assert found.count() == odd_docs.count()
    assert found.filter("tail is null or expected_grade not between 0 and 2").count() == 0
    by_text = odd_docs.filter("text is null or text = ''").count()
    assert by_text == 3
    kept = good_documents(odd_docs, grades, threshold=0.0)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert graded(no_docs, model).collect() == []
    assert good_documents(no_docs, grades).collect() == []


def test_nothing_rated(spark, odd_docs):
    model = fit_quality(odd_docs, spark.createDataFrame([], "doc_id long, grade int"))
    assert isinstance(model, Ordinal)
    values = {(r.expected_grade, r.tail) for r in graded(odd_docs, model).collect()}
    assert values == {(1.0, 0.333333)}


def test_grades(spark):
    rows = [(1, 0, 2), (1, 1, 0), (0, 0, 1), (0, 1, 0), (None, 0, None), (1, None, None)]
    table = spark.createDataFrame(rows, "quality int, toxic int, grade int")
    assert table.filter(~grade_of().eqNullSafe(F.col("grade"))).count() == 0


def test_the_order_of_rows_does_not_matter(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/documents.parquet")
    grades = spark.read.parquet(f"{testdata}/labels.parquet").select("doc_id", grade_of().alias("grade"))
    first = graded(docs, fit_quality(docs, grades)).collect()
    again = graded(docs, fit_quality(docs.repartition(7), grades.repartition(3))).collect()
    assert sorted(first) == sorted(again)
