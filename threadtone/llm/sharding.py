"""Balanced label propagation: linked documents move into one shard, sizes stay even.

Nodes start spread by hash.  In each round, joins count for every linked node how many
of its neighbours each shard has; a node wants to go where most are.  How many may go
from one shard to another is bounded by a quota: as many as want to come back, and a
part of the room that is left.  Those who gain most go first.  Rounds go on until no node
wishes to go where there is room.  Unlinked nodes take up no room, as they can be anywhere: at the end those that exceed the even size move on, and
linked ones only where these do not suffice, so counts differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadtone.llm.common import stored, text_or_empty

#: Rounds end by themselves; this only ends swaps that would go on for ever.
ROUNDS = 60
#: So many rounds without a move while nodes wish to go: the shards they wish for are full.
IDLE = 6
#: Rows that are ordered in one task when places are given out.
STRETCH = 20_000
#: Steps by which a quota is filled; more gain comes first, then a hash decides.
GAINS, PARTS = 16, 64


def ranked(rows: DataFrame, group: str, node: str, count: int, name: str) -> DataFrame:
    """``rows`` with a gapless place from 0 within each ``group``.

    Rows are dealt into stretches by hash; a stretch is ordered in one task and begins
    where the stretches before it end, so no group is ever in one place.
    """
    stretches = max(1, count // STRETCH)
    rows = rows.withColumn("__stretch", F.pmod(F.xxhash64(node), F.lit(stretches)))
    sizes = rows.groupBy(group, "__stretch").agg(F.count("*").alias("__size"))
    before = Window.partitionBy(group).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "__stretch", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    starts = stored(starts, "places")
    inside = F.row_number().over(Window.partitionBy(group, "__stretch").orderBy(node)) - 1
    rows = rows.withColumn("__inside", inside).join(starts.hint("merge"), [group, "__stretch"])
    return rows.withColumn(name, F.col("__start") + F.col("__inside")).drop("__stretch", "__inside", "__start")


def _hash(*parts: str | Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 32))


def _quotas(demand: dict[tuple[int, int], int], counts: list[int], most: int) -> list[tuple[int, int, int]]:
    """``(from, to, how many)``: exchanges in equal numbers, and a part of the room."""
    shards = range(len(counts))
    swap = {(a, b): min(n, demand.get((b, a), 0)) for (a, b), n in demand.items()}
    quotas = []
    for b in shards:
        room = max(0, most - counts[b])
        extra = {a: demand.get((a, b), 0) - swap.get((a, b), 0) for a in shards}
        total = sum(extra.values())
        for a in shards:
            if demand.get((a, b)):
                quotas.append((a, b, swap[a, b] + min(extra[a], room * extra[a] // total if total else 0)))
    return quotas


def propagated(state: DataFrame, links: DataFrame, shards: int, most: int, rounds: int = ROUNDS) -> DataFrame:
    """``node, shard`` of the linked nodes when none wishes to go where there is room.

    At most ``rounds`` are made.  ``state`` has the linked nodes with their first shard, ``links`` their neighbours
    ``src, dst, weight`` once in either direction.  No shard gets beyond ``most`` nodes
    by the room it has; what an exchange leaves open may exceed it by a little.
    """
    spark = state.sparkSession
    sizes = {r.shard: r["count"] for r in state.groupBy("shard").count().collect()}
    counts = [sizes.get(s, 0) for s in range(shards)]
    both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    both = stored(both, "shard-links")
    idle = 0
    for number in range(rounds):
        seen = both.join(state.hint("merge"), both["dst"] == state["node"]).groupBy("src", "shard")
        votes = stored(seen.agg(F.sum("weight").alias("votes")), "shard-votes").alias("v")
        own = state.withColumnsRenamed({"node": "src", "shard": "here"})
        wish = votes.join(own.hint("merge"), "src")
        best = F.max(F.struct("votes", (F.col("shard") == F.col("here")).alias("stay"), (-F.col("shard")).alias("s")))
        now = F.coalesce(F.max(F.when(F.col("shard") == F.col("here"), F.col("votes"))), F.lit(0))
        wish = wish.groupBy("src", "here").agg(best.alias("best"), now.alias("now"))
        wish = wish.select(
            F.col("src").alias("node"),
            "here",
            (-F.col("best.s")).alias("there"),
            F.least(F.floor(F.log2(F.col("best.votes") - F.col("now") + 1)), F.lit(GAINS)).cast("int").alias("gain"),
        ).filter("here != there")
        step = (F.lit(GAINS) - F.col("gain")) * PARTS + F.pmod(F.xxhash64("node", F.lit(-number - 1)), F.lit(PARTS))
        wish = stored(wish.withColumn("step", step), "shard-wishes")
        if wish.isEmpty():
            break
        # Half of the nodes sit a round out, lest neighbours swap places for ever.
        wish = wish.filter(F.pmod(F.xxhash64("node", F.lit(number)), F.lit(2)) == 0)
        # At most shards x shards x (GAINS + 1) x PARTS rows.
        steps = wish.groupBy("here", "there", "step").agg(F.count("*").alias("n"))
        demand = {(r.here, r.there): r.n for r in steps.groupBy("here", "there").agg(F.sum("n").alias("n")).collect()}
        if not demand:
            continue
        quotas = spark.createDataFrame(_quotas(demand, counts, most), "here int, there int, quota long")
        upto = F.sum("n").over(Window.partitionBy("here", "there").orderBy("step"))
        filled = steps.withColumn("upto", upto).join(F.broadcast(quotas), ["here", "there"]).filter("upto <= quota")
        filled = stored(filled.select("here", "there", "step", "n"), "shard-moves")
        moves = filled.groupBy("here", "there").agg(F.sum("n").alias("n")).collect()
        idle = 0 if moves else idle + 1
        if idle == IDLE:
            break
        for r in moves:
            counts[r.here] -= r.n
            counts[r.there] += r.n
        go = wish.join(F.broadcast(filled), ["here", "there", "step"]).select("node", "there")
        state = state.join(go.hint("merge"), "node", "left")
        state = stored(state.select("node", F.coalesce("there", "shard").alias("shard")), "shard-state")
    return state


def evened(placed: DataFrame, shards: int, count: int) -> DataFrame:
    """``placed`` (``node, shard, linked``) with counts that differ by one at most.

    Of a shard that has too many, unlinked nodes leave first.
    """
    spark = placed.sparkSession
    sizes = {(r.shard, r.linked): r["count"] for r in placed.groupBy("shard", "linked").count().collect()}
    even = [count // shards + (s < count % shards) for s in range(shards)]
    have = [sizes.get((s, 0), 0) + sizes.get((s, 1), 0) for s in range(shards)]
    over = [max(0, h - e) for h, e in zip(have, even)]
    gaps = [(s, e - h) for s, (h, e) in enumerate(zip(have, even)) if e > h]
    if not gaps:
        return placed.select("node", "shard")
    # Movers of all shards are numbered through; so are the free places.
    moving, seats, at = [], [], 0
    for s in range(shards):
        moving.append((s, over[s], sizes.get((s, 0), 0), sum(over[:s])))
    for s, free in gaps:
        seats.append((s, at, at + free))
        at += free
    moving = spark.createDataFrame(moving, "shard int, over long, loose long, base long")
    seats = spark.createDataFrame(seats, "seat int, low long, high long")
    rows = placed.withColumn("part", F.col("shard") * 2 + F.col("linked"))
    rows = ranked(rows, "part", "node", count, "place").join(F.broadcast(moving), "shard")
    place = F.col("place") + F.when(F.col("linked") == 1, F.col("loose")).otherwise(0)
    number = F.when(place < F.col("over"), F.col("base") + place)
    rows = rows.withColumn("number", number)
    inside = (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    rows = rows.join(F.broadcast(seats), inside, "left")
    return rows.select("node", F.coalesce("seat", "shard").alias("shard"))


def balanced_shards(
    docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """``key, size, text_crc32, shard, slot`` of every row; equal texts are linked.

    ``size`` is the text's UTF-8 bytes and one.  Every shard gets as many rows as any
    other, or one more; ``slot`` numbers a shard's rows from 0.  A group that exceeds a
    shard is split.  Null texts are empty, and all empty texts are linked.  Every row is
    a node of its own, whatever its key, so repeated rows and null keys count like any
    other.  An empty table gives an empty one.  Other columns are not read.
    """
    raw = text_or_empty(text)
    nodes = docs.select(
        F.monotonically_increasing_id().alias("node"),
        F.col(key).alias("id"),
        (F.octet_length(raw).cast("long") + 1).alias("size"),
        F.crc32(raw).alias("crc"),
        F.sha2(raw, 256).alias("text_hash"),
    )
    nodes = nodes.withColumn("first", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int"))
    nodes = stored(nodes, "shard-nodes")
    hubs = nodes.groupBy("text_hash").agg(F.min("node").alias("dst"), F.count("*").alias("m"))
    hubs = stored(hubs.filter("m > 1").drop("m"), "shard-hubs")
    grouped = stored(nodes.join(hubs.hint("merge"), "text_hash").select("node", "dst", "first"), "shard-groups")
    links = grouped.filter("node != dst").select(F.col("node").alias("src"), "dst", F.lit(1).alias("weight"))
    count = nodes.count()
    state = grouped.select("node", F.col("first").alias("shard"))
    state = propagated(state, links, shards, -(-count // shards), rounds)
    moved = state.withColumnsRenamed({"node": "n", "shard": "s"})
    placed = nodes.select("node", "first").join(moved.hint("merge"), F.col("node") == F.col("n"), "left")
    placed = placed.select(
        "node", F.coalesce("s", "first").alias("shard"), F.when(F.col("s").isNull(), 0).otherwise(1).alias("linked")
    )
    placed = stored(placed, "shard-placed")
    final = stored(evened(placed, shards, count), "shard-final")
    slots = ranked(final, "shard", "node", count, "slot")
    return nodes.join(slots.hint("merge"), "node").select(
        F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", "slot", "text_hash"
    )
