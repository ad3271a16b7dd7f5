import pytest

LONG = "word soup " * 40_000
CLASHING = (
    "id n h t k p row size part shard slot kept keep_id removed n_units fp component_id tail "
    "words raw norm data group_size node linked place share budget weight __t __leaf"
).split()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, columns named like results."""
    rows = [
        (5, "Same text here for all of us.\nAnd a line that comes again and again.", "en", "src1"),
        (3, "Same  text here for all of us.\nAnd a line that comes again and again.", "en", "src1"),
        (9, "Same text here for all of us.\nAnd a line that comes again and again.", "en", None),
        (7, None, None, None),
        (1, "", "en", "src1"),
        (2, " \t\n", "de", "src2"),
        (4, LONG, "en", "src2"),
        (6, LONG + "x", "en", "src2"),
        (8, "Ein völlig anderer Text, mit Ümläuten und ß.", "de", "src0"),
        (8, "Ein völlig anderer Text, mit Ümläuten und ß.", "de", "src0"),
        (8, "another text under a key that is taken", "en", "src0"),
        (None, "a row without a key", "en", "src1"),
        (None, None, None, None),
    ]
    kinds = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASHING)
    extra = tuple("x" for _ in CLASHING)
    return spark.createDataFrame([(*r, *extra) for r in rows], kinds).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")


@pytest.fixture(scope="session")
def texts():
    """``{doc_id: text}`` of the small given table."""
    import duckdb

    return dict(duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall())
