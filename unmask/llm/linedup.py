"""Deleting later copies of repeated line runs, by a suffix array over line ids; DataFrame functions only.

A document is the sequence of its lines that hold a word. Lines found once in the corpus can be in no
repeated run and go first. Prefix doubling then ranks what is left: the rank of a line is its place
among the sorted lines, and the rank of the 2**(k+1) lines from a place on is the place of the pair
(rank of the first 2**k lines, rank of the next 2**k) among the sorted pairs. Places whose pair is found
once leave at every level. So each level is the suffix array of all repeated runs, sorted by their first
2**k lines, and suffixes that share their first n lines are an interval of it, named by the ranks of
the first and the last 2**k of the n lines, where 2**k <= n < 2**(k+1).

A run is worth deleting from ``min_words`` words on. For every place the shortest such run that begins
there and the shortest that ends there are looked up; any longer repeated run is the union of such runs
inside it, so these intervals give exactly the lines of all maximal repeated runs. In an interval the
first run in order of (doc_id, place) stays and the others are deleted.

Scale: rows are a few numbers for each line, and only of lines that repeat. Counts are combined before
they are shuffled, runs are joined on the interval, ranks come from a distributed sort, and runs hold
min_words lines at most, so there are log2(min_words) levels at any size of corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from unmask.llm.common import cols, fresh, quoted, word_count
from unmask.session import Scratch, durable

MIN_WORDS = 50


def lines_of(rows: DataFrame) -> DataFrame:
    """(uid, doc_id, no, key, words) of every line with a word, and a last row without key for the end."""
    lines = F.transform(
        F.split("text", "\n", -1),
        lambda x: F.struct(F.unhex(F.md5(x.cast("binary"))).alias("key"), word_count(x).alias("words")),
    )
    end = F.struct(F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("words"))
    full = F.concat(F.filter(lines, lambda s: s["words"] > 0), F.array(end))
    return rows.filter("text is not null").select("uid", "doc_id", F.posexplode(full).alias("no", "l")).select(
        "uid", "doc_id", "no", "l.key", "l.words"
    )


def ranked(rows: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """(uid, no, r): rows whose keys occur more than once, with the rank of their keys in sorted order."""
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    names = repeated.orderBy(*keys).select(*keys, F.monotonically_increasing_id().alias("r"))
    return scratch.table(rows.join(scratch.table(names), keys).select("uid", "no", "r"))


def shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """(uid, doc_id, s, n): the shortest run of enough words from each place on, and up to each place."""
    by_place = W.partitionBy("uid").orderBy("no").rowsBetween(W.unboundedPreceding, -1)
    before = lines.withColumn("before", F.coalesce(F.sum("words").over(by_place), F.lit(0)))
    by_words = W.partitionBy("uid").orderBy("before")
    runs = before.select(
        "uid", "doc_id", "no",
        F.min("no").over(by_words.rangeBetween(min_words, W.unboundedFollowing)).alias("stop"),
        F.max("no").over(by_words.rangeBetween(W.unboundedPreceding, -min_words)).alias("start"),
    )
    ahead = runs.filter("stop is not null").select("uid", "doc_id", F.col("no").alias("s"), (F.col("stop") - F.col("no")).alias("n"))
    behind = runs.filter("start is not null").select("uid", "doc_id", F.col("start").alias("s"), (F.col("no") - F.col("start")).alias("n"))
    return ahead.union(behind).distinct()


def repeated_runs(rows: DataFrame, min_words: int, scratch: Scratch) -> DataFrame:
    """(uid, s, n): later copies of repeated runs, as ordinals of lines that hold a word."""
    lines = scratch.table(lines_of(rows))
    runs = scratch.table(shortest_runs(lines, min_words))
    level = ranked(lines.filter("key is not null").select("uid", "no", "key"), ["key"], scratch)
    found, size = None, 1
    while size <= min_words and level.take(1):
        mine = runs.filter((F.col("n") >= size) & (F.col("n") < 2 * size))
        first = level.select("uid", F.col("no").alias("s"), F.col("r").alias("r1"))
        last = level.select("uid", (F.col("no") + size).alias("stop"), F.col("r").alias("r2"))
        mine = mine.join(first, ["uid", "s"]).withColumn("stop", F.col("s") + F.col("n")).join(last, ["uid", "stop"])
        mine = scratch.table(mine.select("uid", "doc_id", "s", "n", "r1", "r2"))
        interval = ["n", "r1", "r2"]
        place = F.struct("doc_id", "uid", "s")
        heads = mine.groupBy(*interval).agg(F.count("*").alias("many"), F.min(place).alias("head"))
        later = mine.join(heads.filter("many > 1"), interval).filter((F.col("uid") != F.col("head.uid")) | (F.col("s") != F.col("head.s")))
        later = scratch.table(later.select("uid", "s", "n"))
        found = later if found is None else found.union(later)
        next_lines = W.partitionBy("uid").orderBy("no").rangeBetween(size, size)
        pairs = level.withColumn("r2", F.max("r").over(next_lines)).filter("r2 is not null")
        pairs = scratch.table(pairs.select("uid", "no", F.col("r").alias("r1"), "r2"))
        level = ranked(pairs, ["r1", "r2"], scratch)
        size *= 2
    if found is None:
        found = runs.limit(0).select("uid", "s", "n")
    return found


def drop_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text and any others) without later copies of runs of ``min_words`` words or more.

    ``n_lines`` and ``n_removed`` are added: lines of the text, and how many of them went. Blank lines
    between two deleted lines go with them. Lines are equal if all their characters are. The first copy
    is that of the smallest doc_id (null before all), among equal ids of the row read first, and within a
    document the uppermost; copies may overlap. A null text stays null, an empty one empty, and a text
    all of whose lines went is empty. An empty table gives an empty one. Input columns named as the two
    counts are replaced.
    """
    docs = docs.select(*cols(docs, ("n_lines", "n_removed")))
    uid, cuts_name = fresh(docs, "_uid"), fresh(docs, "_cuts")
    rows = durable(docs.withColumn(uid, F.monotonically_increasing_id()), "line-rows", compression="zstd")
    with Scratch(docs.sparkSession, "lines") as scratch:
        later = repeated_runs(rows.select(quoted(uid).alias("uid"), "doc_id", "text"), min_words, scratch)
        # Runs that touch or overlap are one cut.
        by_start = W.partitionBy("uid").orderBy("s", "n").rowsBetween(W.unboundedPreceding, -1)
        reach = later.distinct().withColumn("reach", F.max(F.col("s") + F.col("n")).over(by_start))
        opens = F.when(F.col("reach").isNull() | (F.col("s") > F.col("reach")), 1).otherwise(0)
        cut = F.sum("opens").over(W.partitionBy("uid").orderBy("s", "n").rowsBetween(W.unboundedPreceding, 0))
        cuts = reach.withColumn("opens", opens).withColumn("cut", cut).groupBy("uid", "cut")
        cuts = cuts.agg(F.min("s").alias("first"), (F.max(F.col("s") + F.col("n")) - 1).alias("last"))
        cuts = cuts.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("cuts"))
        cuts = durable(cuts, "cuts")
    joined = rows.join(cuts.select(F.col("uid").alias(uid), F.col("cuts").alias(cuts_name)), uid, "left")
    lines, cuts_of = F.split(quoted("text"), "\n", -1), quoted(cuts_name)

    def full(ls: Column) -> Column:
        """Numbers of the lines that hold a word."""
        numbers = F.transform(ls, lambda x, i: F.when(x.rlike(r"[^\x20\x09-\x0D]"), i))
        return F.filter(numbers, lambda i: i.isNotNull())

    def between(ls: Column, at: Column) -> Column:
        """Lines outside of the cuts; both ends of a cut are inside it."""
        starts = F.concat(F.array(F.lit(0)), F.transform(cuts_of, lambda c: F.get(at, c["last"]) + 1))
        stops = F.concat(F.transform(cuts_of, lambda c: F.get(at, c["first"])), F.array(F.size(ls)))
        return F.flatten(F.zip_with(starts, stops, lambda a, b: F.slice(ls, a + 1, b - a)))

    # Lines and their numbers are bound to variables, as expressions would be evaluated for every cut.
    kept = F.flatten(F.transform(F.array(lines), lambda ls: F.flatten(F.transform(F.array(full(ls)), lambda at: between(ls, at)))))
    before, after = fresh(joined, "_before"), fresh(joined, "_after")
    done = joined.withColumn(before, F.when(quoted("text").isNull(), 0).otherwise(F.size(lines)))
    done = done.withColumn(after, F.when(cuts_of.isNotNull(), kept))
    is_cut = quoted(after).isNotNull()
    text = F.when(is_cut, F.array_join(quoted(after), "\n")).otherwise(quoted("text"))
    out = [text.alias(c) if c.lower() == "text" else quoted(c) for c in docs.columns]
    n_gone = F.when(is_cut, quoted(before) - F.size(quoted(after))).otherwise(0)
    return done.select(*out, quoted(before).cast("long").alias("n_lines"), n_gone.cast("long").alias("n_removed"))
