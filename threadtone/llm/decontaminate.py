"""Benchmark decontamination: texts that hold passages of a benchmark.

The benchmark's windows of words form a hash set that is broadcast in blocks of a
stated size.  Every window of the documents is looked up by its hash inside one
generated stage, hits are verified word by word, and only hits leave the stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtone.llm.common import ascii_lower, marks, stored, text_or_empty, whole_row, without

WINDOW = 13
#: Windows in one broadcast: about 300 bytes each.
BLOCK = 200_000
#: What is no word character once ``A`` to ``Z`` are in lower case, and before that.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
RAW_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words_of(text: str) -> Column:
    """The words of a text in lower case; none for null."""
    found = F.split(ascii_lower(text_or_empty(text)), SEPARATOR + "+")
    return F.array_remove(found, "")


def item_windows(
    benchmark: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """``item, gram, k``: the windows of every item; a shorter item is one window."""
    items = benchmark.select(F.col(key).alias("item"), words_of(text).alias("words"))
    items = items.filter(F.size("words") > 0).select(
        "item", "words", F.least(F.size("words"), F.lit(window)).alias("k")
    )
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("k") + 1))
    return items.select("item", "words", "k", starts.alias("p")).select(
        "item", F.slice("words", F.col("p"), F.col("k")).alias("gram"), "k"
    ).distinct()


def window_hits(
    docs: DataFrame,
    windows: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """``row, id, n, p, k, gram_id``: verified hits, and one row without for each document.

    ``windows`` has ``gram, k``, each once.  ``row`` numbers the documents, so that
    rows which repeat an id stay apart.
    """
    grams = windows.select(
        F.xxhash64("gram").alias("h"), "gram", "k", F.md5(F.array_join("gram", " ")).alias("gram_id")
    )
    blocks = max(1, -(-grams.count() // block))
    lengths = sorted(r.k for r in grams.select("k").distinct().collect()) or [WINDOW]
    words = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), words_of(text).alias("words")
    ).select("row", "id", "words", F.size("words").alias("n"))
    if blocks > 1:  # Every block must see the same numbers.
        words = stored(words, "decon-words")
    scan = words
    if len(lengths) > 1:
        scan = words.select("*", F.explode(F.array(*map(F.lit, lengths))).alias("length"))
    else:
        scan = words.withColumn("length", F.lit(lengths[0]))
    last = F.greatest(F.col("n") - F.col("length") + 1, F.lit(1))
    scan = scan.select("row", "id", "n", "words", "length", F.explode(F.sequence(F.lit(1), last)).alias("p"))
    here = F.slice("words", F.col("p"), F.col("length"))
    first = (F.col("p") == 1) & (F.col("length") == lengths[0])

    def looked_up(number: int) -> DataFrame:
        part = grams.filter(F.pmod("h", F.lit(blocks)) == number) if blocks > 1 else grams
        found = scan.join(F.broadcast(part), (F.xxhash64(here) == part["h"]) & (here == part["gram"]), "left")
        return found.filter(F.col("gram_id").isNotNull() | (first if number == 0 else F.lit(False)))

    parts = [looked_up(number) for number in range(blocks)]
    return reduce(DataFrame.unionByName, parts).select("row", "id", "n", "p", "k", "gram_id")


def _covered() -> Column:
    """How many words a document's hits cover, from its sorted ``(p, k)``."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(seen: Column, hit: Column) -> Column:
        end = hit["p"] + hit["k"] - 1
        new = F.greatest(end - F.greatest(seen["end"], hit["p"] - 1), F.lit(0))
        return F.struct(
            F.greatest(seen["end"], end).alias("end"), (seen["n"] + new).cast("long").alias("n")
        )

    return F.aggregate("hits", zero, step)["n"]


def _spans() -> Column:
    """The maximal runs of covered words as ``(first, last)``, counted from 1."""
    kind = "array<struct<first:int,last:int>>"

    def step(runs: Column, hit: Column) -> Column:
        end = hit["p"] + hit["k"] - 1
        last = F.element_at(runs, -1)
        new = F.array(F.struct(hit["p"].alias("first"), end.alias("last")))
        grown = F.array(F.struct(last["first"].alias("first"), F.greatest(last["last"], end).alias("last")))
        joined = F.concat(F.slice(runs, 1, F.size(runs) - 1), grown)
        return F.when(F.size(runs) == 0, new).when(
            hit["p"] > last["last"] + 1, F.concat(runs, new)
        ).otherwise(joined).cast(kind)

    return F.aggregate("hits", F.array().cast(kind), step)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = 20,
    block: int = BLOCK,
) -> DataFrame:
    """For every row ``key, n_words, n_hit, items, spans, contaminated``.

    A word is hit if it lies in an occurrence of a window; a text is contaminated if
    the hit words are at least one in ``share``.  ``items`` lists the items found as
    sorted texts, ``spans`` the runs of hit words.  Null and empty texts have no
    words; null or empty items have no window; an empty benchmark hits nothing.  Rows
    that repeat a key are judged one by one.  Other columns are not read.
    """
    windows = stored(item_windows(benchmark, item_key, item_text, window), "decon-windows")
    grams = stored(windows.select("gram", "k").distinct(), "decon-grams")
    hits = stored(window_hits(docs, grams, key, text, block), "decon-hits")
    per_doc = hits.groupBy("row", "id").agg(
        F.max("n").alias("n"),
        F.array_sort(
            F.collect_list(F.when(F.col("gram_id").isNotNull(), F.struct("p", "k")))
        ).alias("hits"),
    )
    owners = windows.select("item", F.md5(F.array_join("gram", " ")).alias("gram_id"))
    items = (
        hits.filter("gram_id is not null").select("row", "gram_id").distinct()
        .join(owners, "gram_id").select("row", F.col("item").cast("string").alias("item")).distinct()
        .groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    judged = per_doc.join(items, "row", "left").select(
        F.col("id").alias(key),
        F.col("n").cast("long").alias("n_words"),
        _covered().alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        _spans().alias("spans"),
    )
    dirty = (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))
    return judged.withColumn("contaminated", dirty)


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows.

    Rows that share a key, null too, are judged each by its own text, and each goes or
    stays by itself.
    """
    name = F.struct(F.col(key).alias("id"), *marks(text))
    found = contamination(docs.select(name.alias("name"), F.col(text).alias("text")), benchmark, "name", "text")
    dropped = stored(found.filter("contaminated").select("name.*"), "decon-dropped")
    return without(docs, dropped, key, [text])


def without_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the hit words, and what stands before each, cut from the text.

    Expects unique keys.  Texts without a hit stay as they are.
    """
    found = contamination(docs, benchmark, key, text).filter("n_hit > 0").select(F.col(key).alias("hit_id"), "spans")
    found = stored(found, "decon-spans")
    word = RAW_SEPARATOR.replace("[", "[^", 1)
    pieces = F.regexp_extract_all("x", F.lit(f"{RAW_SEPARATOR}*{word}+"), F.lit(0))
    tail = F.regexp_extract("x", f"{RAW_SEPARATOR}*$", 0)

    def inside(i: Column) -> Column:
        return F.exists("spans", lambda s: (i + 1 >= s["first"]) & (i + 1 <= s["last"]))

    rest = F.array_join(F.filter(pieces, lambda _, i: ~inside(i)), "")
    rows = docs.select(whole_row(docs), F.col(key).alias("id"), F.col(text).alias("x"))
    rows = rows.join(found.hint("merge"), F.col("id") == F.col("hit_id"), "left")
    rows = rows.select("doc", F.when(F.col("spans").isNull(), F.col("x")).otherwise(F.concat(rest, tail)).alias("x"))
    return rows.select(*(F.col("x").alias(c) if c == text else F.col("doc").getField(c).alias(c) for c in docs.columns))
