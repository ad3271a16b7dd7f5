import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from threadtone.llm.token_files import (
    Encoder, PerfectHash, _hashes, find_keys, read_back, read_records, unkeyed, write_token_files,
)
from threadtone.session import fresh_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_pieces_give_the_library_s_ids(library, texts):
    encode = Encoder(PATH)
    assert encode.in_pieces
    pick = random.Random(1)
    letters = "abZ é'’—,.!  \n\n\t  \x1c\x85  s't1٣½×÷ñ中<|>"
    made = ["".join(pick.choice(letters) for _ in range(pick.randrange(30))) for _ in range(4000)]
    made += ["<|endoftext|>", "a <|endoftext|> b", "don't we'll", *texts.values()]
    assert [np.frombuffer(x, encode.type).tolist() for x in encode(made)] == [ids_of(library, t)[:-1] for t in made]


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encode, library = Encoder(path), Tokenizer.from_file(path)
    assert not encode.in_pieces
    found = np.frombuffer(encode(["Some WORDS, here"])[0], encode.type).tolist()
    assert found == library.encode("Some WORDS, here", add_special_tokens=False).ids


@pytest.mark.parametrize("count", [0, 1, 2, 1000, 30_000])
def test_perfect_hash(count):
    h1, h2 = _hashes([str(i) for i in range(count)])
    found = PerfectHash.build(h1, h2)
    assert sorted(found.find(h1, h2).tolist()) == list(range(count))


def test_given_documents(spark, testdata, library, texts):
    docs = spark.read.parquet(f"{testdata}/documents.parquet")
    folder = fresh_path(spark, "ids")
    write_token_files(docs.repartition(5), folder, PATH, keys_per_bucket=30)
    expect, at = {}, 0
    for key in sorted(texts):
        ids = ids_of(library, texts[key])
        expect[key] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in read_back(docs, folder).collect()} == expect
    wanted = spark.createDataFrame([(3,), (3,), (77,), (10**9,), (-5,), (None,)], "k long")
    some = {r.key: r.ids for r in read_records(find_keys(wanted, folder), folder).collect()}
    assert some == {k: ids_of(library, texts[k]) for k in (3, 77)}


def test_odd_rows(spark, odd_docs, no_docs, library):
    folder = fresh_path(spark, "ids")
    write_token_files(odd_docs, folder, PATH)
    rows = sorted(((r.doc_id, r.text) for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expect, at = [], 0
    for key, text in rows:
        ids = ids_of(library, text)
        expect.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted((tuple(r) for r in read_back(odd_docs, folder).collect()), key=lambda r: r[1])
    assert got == expect
    assert unkeyed(spark, folder).count() == 2
    empty = fresh_path(spark, "ids")
    write_token_files(no_docs, empty, PATH)
    assert read_back(no_docs, empty).collect() == []
    assert read_back(odd_docs, empty).collect() == []


def test_text_keys(spark, library):
    folder = fresh_path(spark, "ids")
    docs = spark.createDataFrame([("b", "two words"), ("a", "one")], "name string, body string")
    write_token_files(docs, folder, PATH, key="name", text="body")
    found = find_keys(spark.createDataFrame([("a",), ("b",), ("c",)], "name string"), folder)
    assert {r.key: (r.position, r.ids) for r in read_records(found, folder).collect()} == {
        "a": (0, ids_of(library, "one")), "b": (len(ids_of(library, "one")), ids_of(library, "two words")),
    }
