"""Comment text to phrase-aware n-grams, as column expressions.

The chain is a handful of regular expressions over the whole string, so it stays
inside generated JVM code: no Python worker, no per-token lambda.  Every pattern
scans its input a constant number of times.  Possessive quantifiers and the
look-behinds below keep it so on hostile input too (a megabyte of ``[`` or of
letters); the plain forms of the link patterns are quadratic there, and one such
row would hold up a task for hours.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtone.constants import (
    PHRASE_END_CHARS,
    SPACE_CHARS,
    URL_STARTS,
    WORD_CHARS,
)


def spelled(members: str) -> str:
    """The members of a character class with its ranges written out.

    Java looks a Latin-1 character that is named up in a table; a range is a chain of
    calls for every character of the text.
    """
    return re.sub("(.)-(.)", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), members)


_W = spelled(WORD_CHARS)
_S = SPACE_CHARS
_END = PHRASE_END_CHARS

# Tabs and line feeds, real or spelled as backslash + letter.
BLANKS = r"[\t\n]|\\[tn]"

# [text](target) becomes text.  The second branch consumes a bracket that starts
# no link together with all that cannot start one either, and puts it back.
MARKDOWN_LINK = (
    r"\[([^\]]*+)\]\([^)]*+\)"
    r"|(\[[^\]]*+(?:\](?:\([^)]*+\z)?|\z))"
)

# A URL, the white space before it and an optional bracketed word, which is kept.
# The first group lists the only places where a leftmost match can begin: a
# bracket, the start of a run of letters, the start of a run of white space, or
# right behind the previous URL.
URL = (
    r"(?:\["
    r"|(?<![a-zA-Z\[])(?=[a-zA-Z\]])"
    rf"|(?:\G|(?<![a-zA-Z\[\]{_S}]))(?=[{_S}]))"
    rf"([a-zA-Z]*)\]?[{_S}]*(?:{URL_STARTS})[^{_S}]*"
)

# One character of a punctuation run at the edge of a token: the run starts the
# token, or follows a word character and reaches the token's end.  \G carries on
# through the run.  Phrase ends are set apart, all else there vanishes.
EDGE_PUNCTUATION = (
    rf"(?=[^{_W} ])"
    rf"(?:\G|(?<![^ ])|(?<=[{_W}])(?=[^{_W} ]++(?![^ ])))"
    rf"(?:([{_END}])|[^{_W} ])"
)

_WORD = rf"[{_W}][^ ]*+"
PHRASE_END_TOKEN = rf"(?<![^ ])[{_END}](?: |\z)"
BIGRAM = rf"(?<![^ ])(?=({_WORD} {_WORD}))[^ ]++ "
TRIGRAM = rf"(?<![^ ])(?=({_WORD} {_WORD} {_WORD}))[^ ]++ "


def _where(text: Column, marks: tuple[str, ...], pattern: str, to: str) -> Column:
    # A byte search for what every match must hold is far cheaper than the
    # pattern, and most texts hold no link.
    found = reduce(lambda a, b: a | b, [text.contains(m) for m in marks])
    return F.when(found, F.regexp_replace(text, pattern, to)).otherwise(text)


def _blanked(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, " ")


def _unlinked(text: Column) -> Column:
    return _where(text, ("](",), MARKDOWN_LINK, "$1$2")


def _without_urls(text: Column) -> Column:
    return _where(text, ("://", "www."), URL, "$1")


def _tokens(text: Column) -> Column:
    text = F.regexp_replace(text, EDGE_PUNCTUATION, " $1 ")
    return F.trim(F.regexp_replace(F.lower(text), " {2,}", " "))


_PARSE_STEPS = (_blanked, _unlinked, _without_urls, _tokens)


def parsed(body: Column) -> Column:
    """Lower-case tokens of ``body`` joined by one space; NULL stays NULL."""
    return reduce(lambda text, step: step(text), _PARSE_STEPS, body)


def without_links(body: Column) -> Column:
    """``body`` on one line, Markdown links reduced to their text, URLs removed."""
    return _without_urls(_unlinked(_blanked(body)))


def _with_parsed_only(df: DataFrame, body: str, output: str) -> DataFrame:
    # One projection per step.  A step reads its input more than once, so the
    # optimizer leaves the projections apart and each runs once per row; as one
    # nested expression the inner steps would be repeated inside the outer ones.
    df = df.withColumn(output, F.col(body))
    for step in _PARSE_STEPS:
        df = df.withColumn(output, step(F.col(output)))
    return df


def unigrams(parsed_text: Column) -> Column:
    """The words of a parsed text, space-joined."""
    return F.rtrim(F.regexp_replace(parsed_text, PHRASE_END_TOKEN, ""))


def _ngram_lines(parsed_text: Column, pattern: str) -> Column:
    # One n-gram per line.  A parsed text holds no line feed, so it can stand
    # between the n-grams while the spaces inside them turn into underscores.
    found = F.regexp_extract_all(parsed_text, F.lit(pattern), F.lit(1))
    return F.replace(F.array_join(found, "\n"), F.lit(" "), F.lit("_"))


def bigrams(parsed_text: Column) -> Column:
    """Neighbouring words of one phrase as ``a_b``, space-joined."""
    return F.replace(_ngram_lines(parsed_text, BIGRAM), F.lit("\n"), F.lit(" "))


def trigrams(parsed_text: Column) -> Column:
    """Three words in a row of one phrase as ``a_b_c``, space-joined."""
    return F.replace(_ngram_lines(parsed_text, TRIGRAM), F.lit("\n"), F.lit(" "))


def gram_list(parsed_text: Column) -> Column:
    """All n-grams as one array.  A kind without any gives one empty string."""
    return F.concat(
        F.split(unigrams(parsed_text), " "),
        F.split(_ngram_lines(parsed_text, BIGRAM), "\n"),
        F.split(_ngram_lines(parsed_text, TRIGRAM), "\n"),
    )


def with_parsed(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``parsed, unigrams, bigrams, trigrams``, the four cleaned texts."""
    p = F.col("parsed")
    return _with_parsed_only(df, body, "parsed").withColumns(
        {"unigrams": unigrams(p), "bigrams": bigrams(p), "trigrams": trigrams(p)}
    )


def with_grams(df: DataFrame, body: str = "body", output: str = "grams") -> DataFrame:
    """Replace ``body`` by its gram list, the input of the bag of words."""
    return (
        _with_parsed_only(df, body, "__parsed")
        .withColumn(output, gram_list(F.col("__parsed")))
        .drop("__parsed", body)
    )


def grams(body: Column) -> Column:
    """Gram list of a body as a single expression."""
    return gram_list(parsed(body))
