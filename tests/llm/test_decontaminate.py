import random
import re

import pytest

from threadtone.llm.decontaminate import clean_documents, contamination, without_spans


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items):
    found = []
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for item, passage in items:
            v = words(passage)
            k = min(13, len(v))
            grams = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if v else set()
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in grams:
                    hit.update(range(p, p + k))
                    names.add(str(item))
        found.append((key, len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(found, key=repr)


def got(df):
    rows = df.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def cases():
    pick = random.Random(4)
    some = [f"w{i}" for i in range(40)] + ["Émile", "été", "THE", "3"]
    text = lambda n: " ".join(pick.choice(some) for _ in range(n))
    items = [(1, text(30)), (2, text(13)), (3, text(4)), (4, "solo"), (5, None), (6, "--"), (None, text(20))]
    items += [(10, items[0][1]), (11, items[1][1] + " " + text(5))]
    docs = [(i, text(pick.randrange(60))) for i in range(40)]
    for i, (_, passage) in enumerate(items):
        if passage:
            docs.append((100 + i, text(pick.randrange(200)) + ", " + passage.upper() + "! " + text(7)))
            docs.append((200 + i, passage))
    docs += [(300, None), (301, ""), (None, items[0][1]), (302, "solo solo solo"), (302, "x " * 5000 + "solo")]
    return docs, items


@pytest.mark.parametrize("block", [200_000, 7])
def test_against_brute_force(spark, cases, block):
    docs, items = cases
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [(k, t) for k, t in items if k is not None]
    expect = brute(docs, named)
    assert got(contamination(table, bench.filter("item_id is not null"), block=block)) == expect


def test_removal(spark, cases):
    docs, items = cases
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    clean = [row for row in docs if not brute([row], items)[0][-1]]
    assert sorted(map(tuple, clean_documents(table, bench).collect()), key=repr) == sorted(clean, key=repr)
    unique = table.filter("doc_id < 300")
    cut = {r.doc_id: r.text for r in without_spans(unique, bench).collect()}
    for key, text in docs:
        if key is not None and key < 300:
            assert brute([(key, cut[key])], items)[0][1] <= len(words(text))
            hit = {r[0]: r[2] for r in brute([(key, text)], items)}[key]
            assert len(words(cut[key])) == len(words(text)) - hit
            if not hit:
                assert cut[key] == text


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "another text under a key that is taken")], "item_id long, text string")
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert got(contamination(odd_docs, bench)) == brute(rows, [(1, "another text under a key that is taken")])
    assert clean_documents(odd_docs, bench).columns == odd_docs.columns
    assert contamination(no_docs, bench).collect() == []
    assert all(not r.contaminated for r in contamination(odd_docs, bench.filter("false")).collect())


def test_clean_rows_stay_beside_contaminated_ones(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    dirty, clean = "alpha beta gamma delta", "nothing of that kind here"
    rows = [(None, dirty), (None, clean), (7, dirty), (7, clean), (7, clean), (8, None), (None, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(map(tuple, clean_documents(docs, bench).collect()), key=repr)
    assert kept == sorted((r for r in rows if r[1] != dirty), key=repr)
