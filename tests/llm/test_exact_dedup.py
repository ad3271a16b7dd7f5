import re

from pyspark.sql import functions as F

from threadtone.llm.exact_dedup import deduplicated, exact_dedup


def expected(rows):
    """The key that stays for each (key, text), by brute force over all pairs."""
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    found = []
    for key, text in rows:
        group = [(k, t) for k, t in rows if norm(t) == norm(text)]
        best = min(group, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        found.append((key, best[0], len(group), key == best[0]))
    return sorted(found, key=repr)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=repr)


def test_odd_rows(odd_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert got(exact_dedup(odd_docs)) == expected(rows)


def test_colliding_hashes_are_told_apart(odd_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    weak = exact_dedup(odd_docs, digest=lambda c: F.md5(F.lit("all alike")))
    assert got(weak) == expected(rows)


def test_rows_that_stay_keep_their_columns(odd_docs):
    kept = deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    # Of the rows without a key one has a text of its own; of the equal rows one stays.
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 4, 6, 8, 8]
    assert kept.exceptAll(odd_docs).count() == 0


def test_empty_table(no_docs):
    assert exact_dedup(no_docs).collect() == []
    assert deduplicated(no_docs).collect() == []
