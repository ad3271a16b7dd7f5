import hashlib
import re

import numpy as np
import pytest
from conftest import LONG
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadtone.llm.fill_in_middle import SkipList, fill_in_middle, line_widths, restored

LINES = re.compile(r"[^\n]*\n|[^\n]+")


def brute(key, text, rate=100, spm=50):
    text = text or ""
    lines = LINES.findall(text)
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return key, n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
    if h[3] % 100 < spm:
        return key, n, "spm", len(a), len(b), "<S>" + c + "<P>" + a + "<M>" + b
    return key, n, "psm", len(a), len(b), "<P>" + a + "<S>" + c + "<M>" + b


@given(st.text(alphabet="ab\n\ré€\U0001f600", max_size=60))
def test_line_widths(text):
    assert line_widths(text).tolist() == [len(x) for x in LINES.findall(text)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=400), st.integers(2, 5))
def test_every_rank_is_reached(widths, stride):
    lines = SkipList(np.array(widths, np.int64), stride)
    ends = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
    assert [lines.seek(i) for i in range(len(widths) + 1)] == ends.tolist()


def test_lanes_are_short():
    lines = SkipList(np.ones(100_000, np.int64))
    sizes = [len(units) for units, _, _ in lines.lanes]
    assert sum(sizes) < 150_000 and len(sizes) < 30 and sizes[-1] <= 4
    assert all(units.sum() == points.sum() == 100_000 for units, points, _ in lines.lanes)
    assert lines.seek(77_777) == 77_777


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_odd_rows(spark, odd_docs, no_docs):
    marked = [(1, "a <P> b\nc"), (2, "<\nP>\nx"), (3, "<S\n>"), (4, "\n\n\n"), (5, "ü€\n\U0001f600 x\ny"), (6, LONG + "\n" + LONG)]
    marked = spark.createDataFrame(marked, "doc_id long, text string")
    for docs in (odd_docs, no_docs, marked):
        found = fill_in_middle(docs)
        assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        assert rows_of(found) == sorted((brute(r.doc_id, r.text) for r in docs.collect()), key=repr)
        whole = found.select("doc_id", restored(F.col("output"), F.col("form")))
        assert rows_of(whole) == rows_of(docs.select("doc_id", F.coalesce("text", F.lit(""))))


def test_rates(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for rate, spm in ((0, 50), (60, 100), (100, 0)):
        expect = sorted((brute(k, t, rate, spm) for k, t in texts.items()), key=repr)
        assert rows_of(fill_in_middle(docs, rate=rate, spm=spm)) == expect
    forms = {r.form for r in fill_in_middle(docs).collect()}
    assert forms == {"psm", "spm"}


def test_overlapping_markers_are_refused(odd_docs):
    with pytest.raises(ValueError, match="overlap"):
        fill_in_middle(odd_docs, markers=("ab", "bc", "x"))
