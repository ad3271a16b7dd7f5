import random

import numpy as np
import pytest

from threadtone.llm import suffix_dedup
from threadtone.llm.suffix_array import suffix_arrays
from threadtone.llm.suffix_dedup import WINDOW, runs_of, without_seen_bytes


def brute(rows):
    """Removed positions of each (key, text): null keys last, equal keys alike."""
    order = sorted({k for k, _ in rows if k is not None}) + [None]
    strings = {k: set() for k in order}
    for key, text in rows:
        raw = (text or "").encode()
        strings[key].update(raw[i : i + WINDOW] for i in range(len(raw) - WINDOW + 1))
    before, seen = {}, set()
    for key in order:
        before[key] = set(seen)
        seen |= strings[key]
    found = []
    for key, text in rows:
        raw = (text or "").encode()
        gone = set()
        for i in range(len(raw) - WINDOW + 1):
            if raw[i : i + WINDOW] in before[key]:
                gone.update(range(i, i + WINDOW))
        runs = [i for i in sorted(gone) if i - 1 not in gone]
        kept = bytes(c for i, c in enumerate(raw) if i not in gone)
        found.append((key, len(raw), len(gone), len(runs), kept))
    return sorted(found, key=repr)


def got(df):
    rows = df.collect()
    return sorted(
        ((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.removed), len(r.removed), bytes(r.kept)) for r in rows),
        key=repr,
    )


def laid_out(problems):
    symbols, bounds = [], [0]
    for texts in problems:
        symbols += [0] + [s for t in texts for s in [*(c + 1 for c in t), 0]]
        bounds.append(len(symbols))
    return np.array(symbols, np.int64), np.array(bounds, np.int64)


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abcd", bytes(range(256))])
def test_suffix_arrays(letters):
    pick = random.Random(len(letters))
    for _ in range(60):
        problems = [
            [bytes(pick.choice(letters) for _ in range(pick.randrange(25))) for _ in range(pick.randrange(1, 5))]
            for _ in range(pick.randrange(1, 6))
        ]
        symbols, bounds = laid_out(problems)
        result = suffix_arrays(symbols, bounds)
        for a, b in zip(bounds[:-1], bounds[1:]):
            own = [(c, i if c == 0 else 0) for i, c in enumerate(symbols[a:b].tolist())]
            assert (result[a:b] - a).tolist() == sorted(range(len(own)), key=lambda i: own[i:])


def test_every_window_is_in_one_run(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    pick = random.Random(1)
    texts = [bytes(pick.choice(b"ab ") for _ in range(n)) for n in (0, 49, 50, 51, 700, 3, 2000, 299, 301)]
    bounds = np.cumsum([0, *map(len, texts)])
    text, start, windows, anchor = runs_of(np.frombuffer(b"".join(texts), np.uint8), bounds)
    seen, names = [], {}
    for t, s, n, a in zip(text, start, windows, anchor):
        for i in range(s, s + n):
            seen.append((int(t), int(i - bounds[t])))
            string = texts[t][i - bounds[t] : i - bounds[t] + WINDOW]
            assert names.setdefault(string, a) == a
    expect = [(t, i) for t, x in enumerate(texts) for i in range(len(x) - WINDOW + 1)]
    assert sorted(seen) == expect


def test_passages_copies_and_periods(spark):
    pick = random.Random(8)
    word = lambda: "".join(pick.choice("abcdeé ") for _ in range(9))
    text = lambda n: "".join(word() for _ in range(n))
    passage, other = text(9), text(7)
    rows = [(i, text(10) + passage + text(pick.randrange(8)) + pick.choice(["", other])) for i in range(60)]
    rows += [(100 + i, rows[i][1][: pick.randrange(200)]) for i in range(30)]
    rows += [(200 + i, "ab" * pick.randrange(120) + "c" + "x" * pick.randrange(120)) for i in range(20)]
    rows += [(300, None), (301, ""), (302, passage[:49]), (303, passage[:50]), (304, passage), (304, passage + "!")]
    rows += [(None, passage), (None, other), (5, rows[3][1])]
    pick.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expect = brute(rows)
    assert got(without_seen_bytes(docs)) == expect
    assert got(without_seen_bytes(docs, group_bytes=2000)) == expect


def test_crowded_anchors(spark):
    pick = random.Random(9)
    phrase = "a phrase of quite some length that many have in common "
    rows = [(i, "".join(pick.choice("xyz") for _ in range(30)) + phrase + "".join(pick.choice("xyz") for _ in range(30))) for i in range(60)]
    rows += [(100 + i, rows[i][1][5:-5]) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert got(without_seen_bytes(docs)) == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    short = odd_docs.filter("text is null or length(text) < 1000")
    rows = [tuple(r) for r in short.select("doc_id", "text").collect()]
    assert got(without_seen_bytes(short)) == brute(rows)
    lengths = {r.doc_id: len(r.kept) for r in without_seen_bytes(odd_docs).filter("doc_id in (4, 6)").collect()}
    assert lengths == {4: 400_000, 6: 1}  # All but what the last byte ends is in the smaller one.
    assert without_seen_bytes(no_docs).collect() == []


@pytest.mark.parametrize("keys", [[None] * 400, [7] * 400, [i * 21 for i in range(400)]])
def test_rows_of_one_key_spread_over_groups(spark, keys):
    rows = [(k, f"text {i}") for i, k in enumerate(keys)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = [r["count"] for r in suffix_dedup._dealt(docs, "doc_id", "text", 21).groupBy("part").count().collect()]
    assert len(sizes) == 21 and max(sizes) < 50


def test_crowded_keys(spark):
    pick = random.Random(11)
    text = lambda: "".join(pick.choice("abc") for _ in range(90))
    rows = [(pick.choice([None, 7]), text()) for _ in range(60)]
    rows += [(i, rows[pick.randrange(60)][1][10:80] + text()) for i in (1, 3, 9, 11)] + [(None, rows[0][1]), (7, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(without_seen_bytes(docs, group_bytes=500)) == brute(rows)
