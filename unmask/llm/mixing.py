"""Mixing sources to target weights in blocks of words, with DataFrame functions only.

Each source's documents, one after another, are cut into blocks of a fixed number of words. A source's
target says how many block slots it fills. Output shards have a fixed number of slots, and how many of
a shard's slots go to each source is a multinomial draw by the sources' slots: every slot draws its
source. Sources drawn too often then hand their last slots to those drawn too rarely, so that totals
meet the targets. The slots of a source, counted through all shards, walk through pseudorandom
permutations of its block numbers, one permutation for each pass, and blocks join slots by number.

A block comes once more or once less than any other of its source, never over the ceiling.

Scale: rows of a source are numbered by pieces; slots and blocks meet on (source, block), keys that no
source can make hot. One task sees a row for each source, and no more.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from unmask.llm.common import cols, fresh, prefix_sums, quoted
from unmask.session import Scratch, durable

SEED = 7_001
WEIGHTS = (5, 2, 1)
CEILING = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 8_192
ROUNDS = 24


class Mixture(NamedTuple):
    """``rows``: the documents with ``uid``; ``sources``: sizes and targets by ``source`` number ``src``;
    ``pieces``: for every slot (shard, slot) the words [word_from, word_from + n_words) of row ``uid``."""

    rows: DataFrame
    sources: DataFrame
    pieces: DataFrame
    uid: str


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """(source, source_size, src, weight, target): shares by weight, none above ``ceiling`` times its size.

    Sources take the weights in turn, by code point and null last. All targets add up to all sizes. The
    excess over a ceiling goes to the others by weight: sources meet their ceiling in the order of
    ceiling to weight, so one sorted pass finds the level that the others share.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sums = sums.withColumn("src", F.row_number().over(by_name) - 1)
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int"))
    sums = sums.select("*", turn.cast("long").alias("weight"), (F.col("source_size") * ceiling).alias("most"))
    order = W.orderBy(F.col("most") / F.col("weight"), "src")
    everything = W.partitionBy()
    before = F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    total = F.sum("source_size").over(everything)
    level = sums.withColumn("total", total).withColumn("level", (F.col("total") - before) / rest)
    level = level.withColumn("level", F.max("level").over(everything))
    level = level.withColumn("full", F.col("most") <= F.col("weight") * F.col("level"))
    full = F.sum(F.when(F.col("full"), F.col("most")).otherwise(0)).over(everything)
    open_ = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    level = level.withColumn("left", F.col("total") - full).withColumn("open", open_)
    shared = F.col("left") * F.col("weight") / F.col("open")
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(shared)
    return level.select("source", "source_size", "src", "weight", target.alias("target"))


def permuted(x: Column, n: Column, key: list[Column], rounds: int = ROUNDS) -> Column:
    """Where a keyed permutation of 0 .. n-1 sends ``x``: a swap-or-not shuffle.

    A round pairs every x with its reflection (k - x) mod n, and a bit of the pair says whether they
    change places, so each round is a permutation for any n.
    """

    def swap(at: Column, i: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, i), n) - at, n)
        coin = F.xxhash64(F.greatest(at, other), i, *key).bitwiseAND(1)
        return F.when(coin == 1, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("long"), swap)


def block_slots(sources: DataFrame, seed: int, shard_slots: int, scratch: Scratch) -> DataFrame:
    """(shard, slot, src, nth): every slot's source, and which of that source's slots it is."""
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    count = sources.count()
    before = W.orderBy("src").rowsBetween(W.unboundedPreceding, -1)
    bounds = sources.select("src", "slots", F.coalesce(F.sum("slots").over(before), F.lit(0)).alias("lo"))
    # A source's stretch of the slots is entered under every cell it touches, so draws find it by equality.
    cell = max(1, total // (4 * max(1, count)))
    cells = bounds.filter("slots > 0").select(
        "src", "lo", (F.col("lo") + F.col("slots")).alias("hi"),
        F.explode(F.sequence(F.expr(f"lo div {cell}"), F.expr(f"(lo + slots - 1) div {cell}"))).alias("cell"),
    )
    slots = spark.range(total).withColumn("v", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(1, total))))
    drawn = slots.withColumn("cell", F.expr(f"v div {cell}")).join(cells, "cell").filter("v >= lo and v < hi")
    drawn = drawn.select(
        "src", F.expr(f"id div {shard_slots}").alias("shard"), (F.col("id") % shard_slots).alias("slot"),
        F.lit(1).cast("long").alias("one"),
    )
    drawn = scratch.table(prefix_sums(scratch.table(drawn), ["src"], "shard", ["slot"], "one", "nth").drop("one"))
    counts = drawn.groupBy("src").agg(F.count("*").alias("drawn"))
    counts = sources.select("src", "slots").join(counts, "src", "left").na.fill(0, ["drawn"])
    over = F.greatest(F.col("drawn") - F.col("slots"), F.lit(0))
    under = F.greatest(F.col("slots") - F.col("drawn"), F.lit(0))
    counts = counts.select(
        "*", F.coalesce(F.sum(over).over(before), F.lit(0)).alias("over_before"),
        F.coalesce(F.sum(under).over(before), F.lit(0)).alias("under_before"),
    )
    counts = scratch.table(counts)
    kept = drawn.join(counts.select("src", "slots", "over_before"), "src")
    spare = kept.filter("nth >= slots").select("shard", "slot", (F.col("over_before") + F.col("nth") - F.col("slots")).alias("k"))
    wanted = counts.filter("slots > drawn").select(
        "src", "under_before", "drawn", F.explode(F.sequence(F.col("drawn"), F.col("slots") - 1)).alias("nth")
    )
    wanted = wanted.select("src", "nth", (F.col("under_before") + F.col("nth") - F.col("drawn")).alias("k"))
    moved = spare.join(wanted, "k").select("shard", "slot", "src", "nth")
    return kept.filter("nth < slots").select("shard", "slot", "src", "nth").union(moved)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    ceiling: int = CEILING,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> Mixture:
    """Mix ``docs`` (doc_id, source, long ``size`` in words, any other columns, which stay with the rows).

    A null source is a source of its own. Documents of size 0 have no words to give. Rows that repeat
    are documents of their own. Empty tables give empty results. Order within a source is by hash and
    value of (doc_id, size), so reruns agree.
    """
    spark = docs.sparkSession
    uid = fresh(docs, "_uid")
    rows = durable(docs.withColumn(uid, F.monotonically_increasing_id()), "mix-rows")
    narrow = rows.select(quoted(uid).alias("uid"), "doc_id", "source", "size")
    with Scratch(spark, "mix") as scratch:
        sources = durable(source_targets(narrow, weights, ceiling), "mix-sources")
        full = F.expr(f"case when source_size > 0 then least(floor(target / source_size), {ceiling}) else 0L end")
        plan = sources.withColumn("blocks", F.ceil(F.col("source_size") / block_words)).withColumn("passes", full)
        rest = F.round((F.col("target") - F.col("passes") * F.col("source_size")) / block_words).cast("long")
        plan = plan.withColumn(
            "slots", F.col("passes") * F.col("blocks") + F.greatest(F.lit(0), F.least(rest, F.col("blocks")))
        )
        plan = scratch.table(plan.select("source", "src", "blocks", "slots"))

        own = narrow.alias("d").join(plan.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        own = own.filter("size > 0").select("uid", "doc_id", "size", "src")
        pieces_of_source = max(1, int(rows.count() ** 0.5))
        own = own.withColumn("piece", F.pmod(F.xxhash64("doc_id", "size"), F.lit(pieces_of_source)))
        own = prefix_sums(scratch.table(own), ["src"], "piece", ["doc_id", "size", "uid"], "size", "start")
        parts = own.withColumn(
            "block",
            F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))),
        )
        first = F.greatest(F.col("start"), F.col("block") * block_words)
        last = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
        parts = parts.select(
            "src", "block", "uid", (first - F.col("start")).alias("word_from"), (last - first).alias("n_words")
        )

        slots = block_slots(plan, seed, shard_slots, scratch).join(plan.select("src", "source", "blocks"), "src")
        key = [F.xxhash64("source"), F.expr("nth div blocks"), F.lit(seed)]
        block = permuted(F.expr("nth % blocks"), F.col("blocks"), key)
        slots = slots.select("src", block.alias("block"), "shard", "slot")
        pieces = slots.join(parts, ["src", "block"]).select("shard", "slot", "uid", "word_from", "n_words")
        pieces = durable(pieces, "mix-pieces")
    return Mixture(rows, sources, pieces, uid)
