import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from threadtone.llm import mixing
from threadtone.llm.mixing import leaf_budgets, mix

WEIGHTS = {"a": 3, "a/x": 2, "b/y/s1": 5, "c": 0}


def filled(budget, children):
    """Shares of ``{name: (weight, cap)}``, a full child at a time."""
    share, left = {n: 0 for n in children}, budget
    open_ = {n for n, (w, _) in children.items() if w > 0}
    while open_:
        level = left / sum(children[n][0] for n in open_)
        full = {n for n in open_ if children[n][1] <= children[n][0] * level}
        if not full:
            for n in open_:
                share[n] = int(children[n][0] * level)
            break
        for n in full:
            share[n] = children[n][1]
            left -= children[n][1]
        open_ -= full
    return share


def brute_budgets(leaves, weights, budget, epochs):
    """``{(domain, lang, source): tokens}`` shares, from the top down."""
    weight = lambda *path: weights.get("/".join(p or "" for p in path), 1)
    cap = lambda *path: epochs * sum(t for k, t in leaves.items() if k[: len(path)] == path)
    found = {}
    tops = {k[:1] for k in leaves}
    first = filled(budget, {t: (weight(*t), cap(*t)) for t in tops})
    for t in tops:
        seconds = {k[:2] for k in leaves if k[:1] == t}
        second = filled(first[t], {s: (weight(*s), cap(*s)) for s in seconds})
        for s in seconds:
            thirds = {k for k in leaves if k[:2] == s}
            found.update(filled(second[s], {x: (weight(*x), cap(*x)) for x in thirds}))
    return found


LEAVES = {
    ("a", "x", "s1"): 100, ("a", "x", "s2"): 10, ("a", "y", "s1"): 1000, ("a", None, "s9"): 7,
    ("b", "y", "s1"): 50, ("b", "y", None): 500, ("c", "x", "s1"): 900, (None, None, None): 80,
}


@pytest.mark.parametrize("budget", [0, 1, 90, 400, 1000, 2500, 100_000])
@pytest.mark.parametrize("epochs", [1, 3])
def test_budgets(spark, budget, epochs):
    rows = [(*k, t, 1) for k, t in LEAVES.items()]
    table = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long, n long")
    got = {(r.domain, r.lang, r.source): r.share for r in leaf_budgets(table, WEIGHTS, budget, epochs).collect()}
    assert got == brute_budgets(LEAVES, WEIGHTS, budget, epochs)
    assert sum(got.values()) <= budget


def brute_mix(rows, weights, share, epochs, seed=42):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = defaultdict(list)
    for key, text, *leaf in rows:
        if count(text):
            by[tuple(leaf)].append((key, count(text)))
    leaves = {k: sum(t for _, t in v) for k, v in by.items()}
    budgets = brute_budgets(leaves, weights, sum(leaves.values()) * share[0] // share[1], epochs)
    found = []
    for leaf, members in by.items():
        full, rest = divmod(budgets[leaf], leaves[leaf])
        turn = lambda m: (hashlib.md5(f"{seed}:{full}:{'' if m[0] is None else m[0]}".encode()).hexdigest(), m[1])
        upto = 0
        for key, t in sorted(members, key=turn):
            upto += t
            found += [(key, t, e) for e in range(full + (upto <= rest))]
    return sorted(found, key=repr)


def got(df):
    return sorted(((r.doc_id, r.mix_tokens, r.mix_epoch) for r in df.collect()), key=repr)


@pytest.mark.parametrize("share", [(1, 3), (1, 1), (9, 2)])
@pytest.mark.parametrize("stretch", [1_000, 4])
def test_against_brute_force(spark, monkeypatch, share, stretch):
    monkeypatch.setattr(mixing, "STRETCH", stretch)
    rows = [(i, "w " * (i * 7 % 23), "abc"[i % 3 and i % 7 % 3], "xy"[i % 2], f"s{i % 5 % 3}") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, d string, lang string, source string").repartition(4)
    found = mix(docs, F.col("d"), F.col("lang"), F.col("source"), WEIGHTS, share, epochs=3)
    assert got(found) == brute_mix(rows, WEIGHTS, share, 3)


def test_odd_rows(odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text", "k", "lang", "source").collect()]
    found = mix(odd_docs, F.col("k"), F.col("lang"), F.col("source"), {}, (4, 1), epochs=2)
    assert found.columns == [*odd_docs.columns, "mix_domain", "mix_tokens", "mix_epoch"]
    assert got(found) == brute_mix(rows, {}, (4, 1), 2)
    assert found.select(*odd_docs.columns).exceptAll(odd_docs.unionAll(odd_docs)).count() == 0
    assert mix(no_docs, F.col("k"), F.col("lang"), F.col("source"), {}).collect() == []


def test_many_sources_are_joined_by_shuffle(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", 1)
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text", "k", "lang", "source").collect()]
    found = mix(odd_docs, F.col("k"), F.col("lang"), F.col("source"), {}, (1, 1))
    assert got(found) == brute_mix(rows, {}, (1, 1), 2)
