"""What the text chain must give, for one string, written the slow and plain way."""

import re
from itertools import groupby

WORD = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_#$%'")
ENDERS = ".!?,;:"
# Fixed patterns of the specification.
LINK = re.compile(r"\[([^\]]*)\]\([^\)]*\)")
URL = re.compile(r"\[?([a-zA-Z]*)\]?\s*(?:https://|http://|www\.)\S*")


def without_links(body):
    for blank in ("\t", "\n", "\\n", "\\t"):
        body = body.replace(blank, " ")
    return URL.sub(r"\1", LINK.sub(r"\1", body))


def tokens(body):
    for piece in without_links(body).split(" "):
        inside = [i for i, ch in enumerate(piece) if ch in WORD]
        if not inside:
            yield from (ch for ch in piece if ch in ENDERS)
            continue
        first, last = inside[0], inside[-1] + 1
        yield from (ch for ch in piece[:first] if ch in ENDERS)
        yield piece[first:last].lower()
        yield from (ch for ch in piece[last:] if ch in ENDERS)


def cleaned(body):
    """(parsed, unigrams, bigrams, trigrams)"""
    toks = list(tokens(body))
    ends = groupby(toks, key=lambda t: t in set(ENDERS))
    phrases = [list(words) for is_end, words in ends if not is_end]
    kinds = []
    for n in (1, 2, 3):
        grams = []
        for phrase in phrases:
            shifted = [phrase[i:] for i in range(n)]
            grams += ["_".join(g) for g in zip(*shifted, strict=False)]
        kinds.append(" ".join(grams))
    return (" ".join(toks), *kinds)


def gram_list(body):
    return [g for kind in cleaned(body)[1:] for g in kind.split(" ")]
