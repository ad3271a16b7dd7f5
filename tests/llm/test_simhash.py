import random
import re

import numpy as np
import pytest
import xxhash

from threadtone.llm.simhash import components, fingerprint, linked, links, near_duplicates, one_of_each


def brute_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """The smallest number reachable from every node, by a search over all pairs."""
    left, found = set(range(len(prints))), {}
    while left:
        start = min(left)
        todo, reached = [start], {start}
        while todo:
            a = todo.pop()
            near = {b for b in left - reached if (prints[a] ^ prints[b]).bit_count() <= 3}
            reached |= near
            todo += near
        found.update(dict.fromkeys(reached, start))
        left -= reached
    return found


@pytest.mark.parametrize("text", ["", "  ", "One", "one two", "A b C d é É", "a\x0bb\x0cc d e", "x y z " * 3])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == brute_print(text)


def test_fingerprint_of_a_text_in_several_pieces():
    pick = random.Random(2)
    text = " ".join(str(pick.randrange(10**9)) for _ in range(150_000))
    words = text.split()
    hashes = np.array([xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)], np.uint64)
    ones = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=int)
    assert fingerprint(text.encode()) == sum(1 << b for b in range(64) if 2 * ones[b] > len(hashes))


def close_prints(seed, count=400):
    """Fingerprints in clusters, so that links abound."""
    pick = random.Random(seed)
    centres = [pick.getrandbits(64) for _ in range(12)] + [0, 2**64 - 1]
    found = set()
    while len(found) < count:
        value = pick.choice(centres)
        for _ in range(pick.randrange(7)):
            value ^= 1 << pick.randrange(64)
        found.add(value)
    return sorted(found)


def roots(pairs, points):
    root = {p: p for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(p) for p in points]


def test_tiles_miss_no_link():
    prints = close_prints(1, 3000)
    points = np.array(prints, np.uint64)
    parts = brute_components(prints)
    forest = linked(points, None).tolist()
    assert roots(forest, prints) == [prints[parts[i]] for i in range(len(prints))]
    half = linked(points[::2], points[1::2]).tolist()
    pairs = [(a, b) for a in prints[::2] for b in prints[1::2] if (a ^ b).bit_count() <= 3]
    assert roots(half, prints) == roots(pairs, prints)


@pytest.mark.parametrize("bucket", [16384, 5])
def test_links_and_components(spark, bucket):
    prints = close_prints(3)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    points = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(5)
    edges = [(r.u, r.v) for r in links(points, bucket=bucket).collect()]
    parts = brute_components(prints)
    same = roots(edges, signed)
    groups = {}
    for i, r in enumerate(same):
        groups.setdefault(r, set()).add(parts[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(parts.values()))
    named = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert [named.get(s, s) for s in signed] == same


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    parts = brute_components([brute_print(t) for _, t in rows])
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[parts[i]] = min(key, least.get(parts[i], key))
    expect = sorted(((k, least.get(parts[i])) for i, (k, _) in enumerate(rows)), key=repr)
    got = near_duplicates(odd_docs)
    assert sorted(((r.doc_id, r.component_id) for r in got.collect()), key=repr) == expect
    assert near_duplicates(no_docs).collect() == []
    kept = one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    # One row for each component, with its smallest key.
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((least.get(p) for p in set(parts.values())), key=repr)
    assert kept.exceptAll(odd_docs).count() == 0
    assert one_of_each(no_docs).count() == 0


def test_one_row_of_each_group(spark):
    """Repeated keys, null keys and equal rows: a row of each group stays, and only one."""
    texts = ["one two three four five", "six seven eight nine ten", "just another text of words"]
    rows = [(8, texts[0], "a"), (8, texts[0], "a"), (8, texts[0], "b"), (None, texts[1], "c"), (None, texts[1], "c")]
    rows += [(None, texts[2], "d"), (8, texts[2], "e"), (9, texts[0], "f"), (None, texts[0], "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark1 string").repartition(4)
    kept = sorted(map(tuple, one_of_each(docs).collect()), key=repr)
    assert [(k, t) for k, t, _ in kept] == [(8, texts[2]), (8, texts[0]), (None, texts[1])]
    assert all(k in rows for k in kept)


def test_given_documents(spark, testdata, texts):
    keys = sorted(texts)
    parts = brute_components([brute_print(texts[k]) for k in keys])
    docs = spark.read.parquet(f"{testdata}/documents.parquet")
    got = {r.doc_id: (r.fp, r.component_id) for r in near_duplicates(docs).collect()}
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    assert got == {k: (signed(brute_print(texts[k])), keys[parts[i]]) for i, k in enumerate(keys)}
