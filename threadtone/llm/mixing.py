"""Mixing sources to target weights, as budgets that run down a tree.

The tree has three levels: domain, language, source.  A budget of tokens is divided
among the children of a node by their weights; a child that has less than its share
gives the shortage to its siblings, and only what all of them cannot take goes to the
siblings of their parent.  Each source then gives the first tokens of a stream of
epochs, every epoch a permutation of its documents by seed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadtone.llm.common import BLANK, stored, text_or_empty, whole_row

LEVELS = ("domain", "lang", "source")
#: Documents of a source that share a stretch of its permutation.
STRETCH = 1_000
#: Sources whose budgets are broadcast; more are joined by shuffle.
BROADCAST_LEAVES = 100_000


def n_words(text: str) -> Column:
    """Words between blanks; none in null."""
    return F.regexp_count(text_or_empty(text), F.lit(BLANK.replace("[", "[^", 1) + "+")).cast("long")


def divided(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children`` (``weight, cap, budget`` of the parent) with their own ``share``.

    The shares fill up like water: all children stand at one level per weight unless
    their cap is lower.  With the children in the order of cap per weight, the level is
    the highest of those found by taking the first ones as full.
    """
    at = Window.partitionBy(*parent).orderBy(
        F.col("weight") <= 0, F.col("cap") / F.nullif("weight", F.lit(0)), name
    )
    before = F.sum("cap").over(at.rowsBetween(Window.unboundedPreceding, -1))
    rest = F.sum(F.greatest("weight", F.lit(0))).over(at.rowsBetween(0, Window.unboundedFollowing))
    level = (F.col("budget") - F.coalesce(before, F.lit(0))) / F.nullif(rest, F.lit(0))
    share = F.floor(F.col("weight") * F.greatest("level", F.lit(0.0))).cast("long")
    return (
        children.withColumn("level", level)
        .withColumn("level", F.max("level").over(Window.partitionBy(*parent)))
        .withColumn("share", F.when(F.col("weight") > 0, F.least("cap", share)).otherwise(F.lit(0)))
        .drop("level")
    )


def _weight(weights: Mapping[str, int], path: Column) -> Column:
    known = [x for pair in weights.items() for x in map(F.lit, pair)]
    found = F.element_at(F.create_map(*known), path) if known else F.lit(None)
    return F.coalesce(found.cast("long"), F.lit(1).cast("long"))


def leaf_budgets(
    leaves: DataFrame, weights: Mapping[str, int], budget: int, epochs: int
) -> DataFrame:
    """``leaves`` (the levels, ``tokens, n``) with ``share``, the tokens each is to give.

    ``weights`` are whole numbers by path, such as ``web``, ``web/en``, ``web/en/src0``;
    a path that is not listed weighs 1, one with 0 gives nothing.
    """
    domain, lang, source = LEVELS
    capped = leaves.withColumn("cap", F.col("tokens") * epochs)
    part = lambda *names: F.concat_ws("/", *(F.coalesce(n, F.lit("")) for n in names))
    paths = [part(*LEVELS[: i + 1]) for i in range(3)]
    top = capped.groupBy(domain).agg(F.sum("cap").alias("cap"))
    top = top.withColumns({"weight": _weight(weights, paths[0]), "budget": F.lit(budget).cast("long"), "root": F.lit(0)})
    top = divided(top, ["root"], domain).select(F.col(domain).alias("d"), F.col("share").alias("budget"))
    middle = capped.groupBy(domain, lang).agg(F.sum("cap").alias("cap"))
    middle = middle.join(top, F.col(domain).eqNullSafe(F.col("d"))).drop("d").withColumn("weight", _weight(weights, paths[1]))
    middle = divided(middle, [domain], lang).select(
        F.col(domain).alias("d"), F.col(lang).alias("l"), F.col("share").alias("budget")
    )
    same = F.col(domain).eqNullSafe(F.col("d")) & F.col(lang).eqNullSafe(F.col("l"))
    low = capped.join(middle, same).drop("d", "l").withColumn("weight", _weight(weights, paths[2]))
    return divided(low, [domain, lang], source).select(*LEVELS, "tokens", "n", "share")


def mix(
    docs: DataFrame,
    domain: Column,
    lang: Column,
    source: Column,
    weights: Mapping[str, int],
    share: tuple[int, int] = (1, 2),
    epochs: int = 2,
    seed: int = 42,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The chosen rows of ``docs`` with ``mix_domain, mix_tokens, mix_epoch`` added.

    The budget is ``share`` (a fraction) of the tokens there are, a source gives at
    most ``epochs`` times what it has, and a row comes once for every epoch it is
    chosen in.  A source's last epoch ends before the first document that would exceed
    its share.  Null names are a name of their own.  Null and empty texts have no tokens and are
    not chosen.  Repeated rows have the same place in the permutation, one after the
    other.  An empty table gives an empty one.  Other columns go along as they are.

    A source may hold any part of the rows: sums come from partial aggregates over
    stretches of the permutation, and only the one stretch in which a source's share
    ends is ordered.
    """
    tree = dict(zip(LEVELS, (domain, lang, source)))
    narrow = docs.select(*(c.alias(n) for n, c in tree.items()), F.col(key).alias("id"), n_words(text).alias("t"))
    narrow = stored(narrow.filter("t > 0"), "mix-rows")
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("t").alias("tokens"), F.count("*").alias("n"))
    leaves = stored(leaves, "mix-leaves")
    total, count = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count("*")).first()
    plan = leaf_budgets(leaves, weights, total * share[0] // share[1], epochs)
    plan = plan.select(
        F.struct(*LEVELS).alias("leaf"),
        F.expr("share div tokens").alias("full"),
        F.expr("share % tokens").alias("rest"),
        F.ceil(F.col("n") / STRETCH).alias("stretches"),
    )
    plan = stored(plan.withColumn("leaf", F.to_json("leaf", {"ignoreNullFields": "false"})), "mix-plan")

    def named(columns: dict[str, Column]) -> Column:
        return F.to_json(F.struct(*(c.alias(n) for n, c in columns.items())), {"ignoreNullFields": "false"}).alias("leaf")

    def placed(rows: DataFrame, small: DataFrame) -> DataFrame:
        """Rows with their source's plan and their place in its last epoch."""
        rows = rows.join(F.broadcast(small) if count <= BROADCAST_LEAVES else small.hint("merge"), "leaf")
        turn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
        place = F.conv(F.substring("turn", 1, 8), 16, 10).cast("long")
        return rows.withColumn("turn", turn).withColumn("stretch", F.shiftright(place * F.col("stretches"), 32))

    own = {n: F.col(n) for n in LEVELS}
    sums = placed(narrow.select("id", "t", named(own)), plan).groupBy("leaf", "rest", "stretch").agg(F.sum("t").alias("t"))
    along = Window.partitionBy("leaf").orderBy("stretch")
    sums = sums.withColumn("upto", F.sum("t").over(along)).filter("upto > rest")
    last = F.min(F.struct("stretch", (F.col("upto") - F.col("t")).alias("before")))
    ends = sums.groupBy("leaf").agg(last.alias("last")).select("leaf", F.col("last.stretch").alias("end"), "last.before")
    ends = stored(plan.join(ends, "leaf"), "mix-ends")
    rows = docs.select(
        whole_row(docs), domain.alias("mix_domain"), named(tree), F.col(key).alias("id"), n_words(text).alias("t")
    )
    rows = placed(rows.filter("t > 0"), ends)
    upto = F.sum("t").over(Window.partitionBy("leaf").orderBy("turn", "t").rowsBetween(Window.unboundedPreceding, 0))
    cut = rows.filter("stretch = end").withColumn("upto", upto)
    more = F.when(F.col("before") + F.col("upto") <= F.col("rest"), 1).otherwise(0)
    cut = cut.withColumn("times", F.col("full") + more).drop("upto")
    sure = F.when(F.col("stretch") < F.col("end"), 1).otherwise(0)
    rows = rows.filter("stretch != end").withColumn("times", F.col("full") + sure)
    rows = rows.unionByName(cut).filter("times > 0")
    epochs_of = F.sequence(F.lit(0).cast("long"), F.col("times") - 1)
    return rows.select("doc", "mix_domain", F.col("t").alias("mix_tokens"), F.explode(epochs_of).alias("mix_epoch")).select(
        "doc.*", "mix_domain", "mix_tokens", "mix_epoch"
    )
