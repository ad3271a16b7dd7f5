import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.scalar_text import cleaned, gram_list, without_links
from threadtone.constants import WORD_CHARS
from threadtone.functions import text
from threadtone.functions.sql import register_functions

# input, parsed, grams
EXPECTED = [
    ("Hello", "hello", ["hello", "", ""]),
    ("", "", ["", "", ""]),
    (
        "I don't know, really... OK?",
        "i don't know , really . . . ok ?",
        ["i", "don't", "know", "really", "ok", "i_don't", "don't_know", "i_don't_know"],
    ),
    ("see http://x.y/z now", "see now", ["see", "now", "see_now", ""]),
    (
        "a [link](http://u.v) here",
        "a link here",
        ["a", "link", "here", "a_link", "link_here", "a_link_here"],
    ),
    ("seehttp://q end", "see end", ["see", "end", "see_end", ""]),
    ("HTTP://q r", "http://q r", ["http://q", "r", "http://q_r", ""]),
    (
        "café Ñandu naïve",
        "caf andu naïve",
        ["caf", "andu", "naïve", "caf_andu", "andu_naïve", "caf_andu_naïve"],
    ),
    (
        'well -- "quoted" text',
        "well quoted text",
        ["well", "quoted", "text", "well_quoted", "quoted_text", "well_quoted_text"],
    ),
    (
        "3.14 e-mail a,b",
        "3.14 e-mail a,b",
        ["3.14", "e-mail", "a,b", "3.14_e-mail", "e-mail_a,b", "3.14_e-mail_a,b"],
    ),
    (
        "one\\ntwo three",
        "one two three",
        ["one", "two", "three", "one_two", "two_three", "one_two_three"],
    ),
    ("'tis' (fine)", "'tis' fine", ["'tis'", "fine", "'tis'_fine", ""]),
    ("Привет мир", "", ["", "", ""]),
    ("a\\rb", "a\\rb", ["a\\rb", "", ""]),
]

PIECES = [
    "word", "It's", "café", "Ñandu", "naïve", "3.14", "a,b", "e-mail", "100%", "#tag", "$5",
    " ", "  ", "     ", "\t", "\n", "\r", "\\n", "\\t", "\\r", "\\", "\x0b", "\x1c", "\x85",
    "\xa0", "\u1680", "\u2003", "\u2028", "\u2029", "\u202f", "\u3000", "\u200b",
    ".", "..", "...", "!", "?!", ",", ";", ":", "-", "--", '"', "(", ")", "[", "]", "](",
    "[]", "[[", "]]", "[text]", "[text](target)", "[a b](", "(x)",
    "http://", "https://x.y/z?q=1", "http://a", "www.", "www.site.org", "HTTP://q", "ttp://",
    "abchttp://x", "wwwwww.x", "[w]http://t", "[w] www.t", "] http://u", "www.http://v",
    "😀", "ж", "Σ", "ΑΣ", "İ", "K", "&gt;", "/s", "_", "__", "'", "''", "x", "Y", "Z9",
]


def fuzz(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        glue = rng.choice(["", "", " "])
        yield glue.join(rng.choice(PIECES) for _ in range(rng.randrange(0, 25)))


def bodies(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, body string")


@pytest.mark.parametrize("body, parsed, grams", EXPECTED)
def test_scalar_model_agrees_with_fixed_cases(body, parsed, grams):
    assert cleaned(body)[0] == parsed
    assert gram_list(body) == grams


def test_fixed_cases(spark):
    df = bodies(spark, [body for body, _, _ in EXPECTED])
    parsed = text.with_parsed(df).orderBy("id").collect()
    assert [r.parsed for r in parsed] == [p for _, p, _ in EXPECTED]
    grams = text.with_grams(df).orderBy("id").collect()
    assert [r.grams for r in grams] == [g for _, _, g in EXPECTED]
    assert "body" not in text.with_grams(df).columns


def test_fuzzed_texts(spark):
    texts = list(fuzz(20_000, seed=11))
    df = bodies(spark, texts).repartition(8)
    got = {
        r.id: (r.parsed, r.unigrams, r.bigrams, r.trigrams)
        for r in text.with_parsed(df).drop("body").collect()
    }
    wrong = [(t, got[i], cleaned(t)) for i, t in enumerate(texts) if got[i] != cleaned(t)]
    assert not wrong, wrong[:3]


def test_fuzzed_links(spark):
    texts = list(fuzz(20_000, seed=12))
    df = bodies(spark, texts).select("id", text.without_links(F.col("body")).alias("x"))
    got = {r.id: r.x for r in df.collect()}
    wrong = [(t, got[i]) for i, t in enumerate(texts) if got[i] != without_links(t)]
    assert not wrong, wrong[:3]


def test_expression_form_and_sql_form_agree(spark):
    register_functions(spark)
    df = bodies(spark, list(fuzz(300, seed=13)) + [b for b, _, _ in EXPECTED])
    df.createOrReplaceTempView("some_bodies")
    staged = {r.id: r.grams for r in text.with_grams(df).collect()}
    single = df.select("id", text.grams(F.col("body")).alias("grams")).collect()
    by_sql = spark.sql("SELECT id, sanitize(body) AS grams FROM some_bodies")
    assert {r.id: r.grams for r in single} == staged
    assert {r.id: r.grams for r in by_sql.collect()} == staged
    assert "Python" not in plan_of(by_sql)


def test_null_body_stays_null(spark):
    df = spark.createDataFrame([(1, None)], "id int, body string")
    row = text.with_parsed(df).first()
    assert row.parsed is None and row.unigrams is None and row.trigrams is None
    assert text.with_grams(df).first().grams is None


def test_whole_chain_is_one_generated_stage(spark):
    df = bodies(spark, ["a b"]).repartition(2)
    grams = text.with_grams(df)
    grams.collect()
    plan = plan_of(grams).split("Initial Plan")[0]
    projections = [line for line in plan.splitlines() if "Project [" in line]
    assert len(projections) >= 2
    assert all("*(" in line for line in projections), plan
    assert "Python" not in plan


@pytest.mark.parametrize(
    "hostile",
    [
        "[" * 300_000,
        "[a](" * 80_000,
        "[a] " * 80_000 + "](",
        "a" * 300_000 + " ://",
        " " * 300_000 + "://",
        "www " * 80_000 + "www.",
        "]" * 300_000 + "://",
        "http" * 80_000 + "://",
        " a" * 150_000 + "://",
        "." * 300_000,
        "a" + "-" * 300_000,
        "a.-" * 100_000 + "b",
        "-a" * 150_000,
    ],
    ids=lambda s: repr(s[:6]),
)
def test_hostile_text_takes_linear_time(spark, hostile):
    df = bodies(spark, [hostile])
    started = time.monotonic()
    text.with_grams(df).select(F.size("grams")).collect()
    assert time.monotonic() - started < 10


def test_patterns_name_every_word_character():
    class_of = re.compile(f"[{text.spelled(WORD_CHARS)}]")
    old = re.compile(f"[{WORD_CHARS}]")
    assert all(bool(class_of.match(chr(c))) == bool(old.match(chr(c))) for c in range(0x3000))
    for pattern in (text.EDGE_PUNCTUATION, text.BIGRAM, text.TRIGRAM):
        assert "a-z" not in pattern and text.spelled(WORD_CHARS) in pattern
