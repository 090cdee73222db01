"""Phrase collocations by SON partitioning.

The documents are dealt to eight shards. A phrase that a language holds ``least`` times or more is found
in some shard at its share or more: ``least`` times the shard's text over the language's text, in bytes. So
every shard is mined completely at that lower support, for words, pairs and then longer phrases (a phrase can
only be frequent where all its pairs are). The phrases frequent in some shard are united; those that cannot
reach ``least`` over all shards go; all others are counted exactly over all documents.

A shard is a label, not a task: its counts are an aggregate that Spark spreads as any other, so a shard
may hold an eighth of any corpus. Counting in a shard goes by hashes of the phrase, which can only add
candidates; the exact count goes by the words themselves. Between the levels the candidates' hashes are a
bitmap of fixed size, which lets through too much but never too little.

Scale: every slice of text is counted where it is read, and sums are combined before the shuffle, so a phrase
that fills a third of the corpus is a row a slice. Nothing grows on the driver: bitmaps have a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from unmask.llm.common import shuffle_partitions
from unmask.llm.split import Bitmap, Words, byte_table, split_words, text_slices
from unmask.session import Scratch, durable

LEAST = 30
LONGEST = 4
SHARDS = 8
BEST = 2_000
COVERED_PERCENT = 80
# Parts of a language that are ranked apart before the best of all are.
RANK_PARTS = 64
# Cuts that one task joins with the counts of a frequent part.
CUTS_PER_SALT = 100_000
PIECE_END = r"[.,;:!?\x0A-\x0D]"
_TABLE = byte_table(b" \t", b".,;:!?\x0a\x0b\x0c\x0d")
_SHARD_BITS = np.uint64(SHARDS - 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Grams:
    """Phrases of 1, 2, .. words of some texts: ``h`` their hashes with language, ``at`` their first words."""

    def __init__(self, texts: list[str | None], langs: list[str]):
        self.words: Words = split_words(texts, _TABLE)
        by_lang = {x: xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 1) for x in set(langs)}
        self.lang = np.array([by_lang[x] for x in langs], dtype=np.uint64)[self.words.doc] if langs else np.zeros(0, np.uint64)
        self.word_hash = self.words.hashes()[self.words.code]
        self.k, self._raw = 1, self.word_hash
        self.at = np.arange(len(self.word_hash))

    @property
    def h(self) -> np.ndarray:
        """The low bits are clear; a shard may stand there."""
        return _mixed(self._raw + self.lang[self.at]) & ~_SHARD_BITS

    def longer(self, frequent: Bitmap | None) -> None:
        """On to phrases one word longer whose parts without the first and without the last word are in the set."""
        good = np.zeros(len(self.words.code) + 1, dtype=bool)
        good[self.at if frequent is None else self.at[frequent.has(self.h)]] = True
        raw = np.zeros(len(good), dtype=np.uint64)
        raw[self.at] = self._raw
        at = np.flatnonzero(good[:-1] & good[1:])
        piece = self.words.piece
        at = at[piece[at] == piece[at + 1]] if self.k == 1 else at
        self.k += 1
        last = at + self.k - 1
        self._raw = _mixed(raw[at]) + np.uint64(0xC2B2AE3D27D4EB4F) * self.word_hash[last]
        self.at = at


def _local_counts(docs: DataFrame, sets: list[Bitmap], lengths: int) -> DataFrame:
    """(h, shard, need, n): phrases of ``lengths`` lengths from len(sets) + 1 words on by hash, in each slice.

    A phrase longer than the sets go has to have all its shorter parts in them as far as they go.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                grams = Grams(part.column(0).to_pylist(), part.column(1).to_pylist())
                for frequent in sets:
                    grams.longer(frequent)
                for more in range(lengths):
                    if more:
                        grams.longer(None)
                    doc = grams.words.doc[grams.at]
                    shard = np.asarray(part.column(2)).astype(np.uint64)[doc]
                    key, first, n = np.unique(grams.h | shard, return_index=True, return_counts=True)
                    need = np.asarray(part.column(3))[doc[first]]
                    columns = [
                        pa.array((key & ~_SHARD_BITS).view(np.int64)), pa.array((key & _SHARD_BITS).astype(np.int8)),
                        pa.array(need), pa.array(n.astype(np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["h", "shard", "need", "n"])

    return docs.select("text", "lang", "shard", "need").mapInArrow(run, "h long, shard byte, need long, n long")


def candidates(docs: DataFrame, sets: list[Bitmap], least: int, lengths: int = 1) -> DataFrame:
    """(h): hashes of phrases that reach their support in some shard, and ``least`` over all."""
    # Slices are counted already, so rows go by phrase at once, and both sums are made where they arrive.
    counts = _local_counts(docs, sets, lengths).repartition(shuffle_partitions(docs.sparkSession), "h")
    in_shard = counts.groupBy("h", "shard").agg(F.sum("n").alias("n"), F.min("need").alias("need"))
    whole = in_shard.groupBy("h").agg(F.sum("n").alias("n"), F.max(F.col("n") >= F.col("need")).alias("mined"))
    return whole.filter(F.col("mined") & (F.col("n") >= least)).select("h")


def counted(texts: list[str | None], langs: list[str], sets: list[Bitmap]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, k, n) for each length k: how often the phrases let through by its set occur.

    Length 0 counts each document's words. A phrase may stand in several rows.
    """
    grams = Grams(texts, langs)
    words = grams.words
    names, lang_of = words.names.cast(pa.string()), pa.array(langs, pa.string())

    def rows(at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        spelled = [names.take(pa.array(words.code[at + i])) for i in range(grams.k)]
        phrase = pa.compute.binary_join_element_wise(*spelled, " ") if grams.k > 1 else spelled[0]
        columns = [lang_of.take(pa.array(words.doc[at])), phrase, pa.array(np.full(len(at), grams.k, dtype=np.int32)), pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "k", "n"])

    sizes = np.bincount(words.doc, minlength=len(langs))
    none = [pa.array([""] * len(langs), pa.string()), pa.array(np.zeros(len(langs), dtype=np.int32))]
    yield pa.RecordBatch.from_arrays([lang_of, *none, pa.array(sizes.astype(np.int64))], names=["lang", "phrase", "k", "n"])
    for level, frequent in enumerate(sets):
        if level:
            grams.longer(sets[level - 1])
        h = grams.h
        yes = frequent.has(h)
        at = grams.at[yes]
        _, first, which, n = np.unique(h[yes], return_index=True, return_inverse=True, return_counts=True)
        # Phrases that share a hash with another one are told apart by their words, and stand in rows of their own.
        example = at[first][which]
        other = grams.lang[at] != grams.lang[example]
        for i in range(grams.k):
            other |= words.code[at + i] != words.code[example + i]
        yield rows(at[first], n - np.bincount(which[other], minlength=len(first)))
        if other.any():
            yield rows(at[other], np.ones(int(other.sum())))


def _candidate_counts(docs: DataFrame, sets: list[Bitmap]) -> DataFrame:
    """(lang, phrase, k, n): the candidates' occurrences in each slice of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                yield from counted(part.column(0).to_pylist(), part.column(1).to_pylist(), sets)

    return docs.select("text", "lang").mapInArrow(run, "lang string, phrase string, k int, n long")


def _whole(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``best`` collocations of ``docs`` (text, lang).

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the cut that scores least, ``n`` the language's
    words. A null text is an empty one, a null language is ``und``. Every row counts, repeated ones too.
    An empty table, and one without a frequent phrase, give an empty answer.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(SHARDS)))
    with Scratch(spark, "collocations") as scratch:
        held = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).cast("long")
        sizes = scratch.table(rows.groupBy("lang", "shard").agg(held.alias("held")))
        whole = sizes.groupBy("lang").agg(F.sum("held").alias("whole")).filter("whole > 0")
        # ceil(least * held / whole) in whole numbers.
        need = F.call_function("div", _whole("held") * F.lit(least) + _whole("whole") - F.lit(1), _whole("whole"))
        needs = scratch.table(sizes.join(whole, "lang").select("lang", "shard", need.cast("long").alias("need")))
        dealt = rows.join(needs, ["lang", "shard"])
        sets: list[Bitmap] = []
        for lengths in (1, 1, LONGEST - 2):
            sets.append(Bitmap.of(scratch.table(candidates(dealt, sets, least, lengths))))
        sets += sets[-1:] * (LONGEST - len(sets))
        counts = _candidate_counts(rows, sets).groupBy("lang", "phrase", "k").agg(F.sum("n").alias("a"))
        counts = scratch.table(counts.filter((F.col("a") >= least) | (F.col("k") == 0)))
        langs = counts.filter("k = 0").select("lang", F.col("a").alias("n"))
        counts = counts.filter("k > 0")

        found = counts.filter("k >= 2").withColumn("words", F.split("phrase", " "))
        cuts = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
        joined = lambda start, n: F.array_join(F.slice("words", start, n), " ")
        cuts = cuts.select(
            "lang", "phrase", "k", "a", "cut", joined(F.lit(1), F.col("cut")).alias("first"), joined(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest")
        )
        for part, name in (("first", "l"), ("rest", "r")):
            cuts = _with_count(cuts, counts, part, name, scratch)
        score = F.call_function("div", F.lit(2_000_000).cast("decimal(38,0)") * _whole("a"), _whole("l") + _whole("r"))
        lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low")
        scored = cuts.groupBy("lang", "phrase", "k", "a").agg(lowest)

        longer = found.filter("k >= 3").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
        longer = longer.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
        inside = longer.groupBy("lang", joined(F.col("start"), F.col("size")).alias("phrase")).agg(F.max("a").alias("within"))
        out = scored.join(inside, ["lang", "phrase"], "left")
        out = out.filter(F.col("within").isNull() | (_whole("within") * 100 < _whole("a") * COVERED_PERCENT))
        order = [F.desc("score"), F.desc("a"), "phrase"]
        out = out.select("lang", "phrase", "a", F.col("low.l").alias("l"), F.col("low.r").alias("r"), F.col("low.score").alias("score"))
        # The best of each part first, so that the last ranking sees a bounded number of rows of a language.
        part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("part")
        out = out.select("*", F.row_number().over(W.partitionBy("lang", part).orderBy(*order)).alias("nth")).filter(F.col("nth") <= best)
        rank = F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")
        out = out.withColumn("rank", rank).filter(F.col("rank") <= best).join(langs, "lang")
        return durable(out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")


def _with_count(cuts: DataFrame, counts: DataFrame, part: str, name: str, scratch: Scratch) -> DataFrame:
    """Cuts with the count of one part. A part of very many phrases is salted: its count is one row, copied."""
    tallies = cuts.groupBy("lang", F.col(part).alias("piece")).agg(F.ceil(F.count("*") / F.lit(CUTS_PER_SALT)).cast("int").alias("salts"))
    sums = counts.select("lang", F.col("phrase").alias("piece"), F.col("a").alias(name)).join(tallies, ["lang", "piece"])
    sums = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    sums = scratch.table(sums)
    most = sums.agg(F.coalesce(F.max("salts"), F.lit(1))).first()[0]
    salts = sums.filter("salt = 0 and salts > 1").select("lang", F.col("piece").alias(part), "salts")
    if most > 1:
        # At most one row for every CUTS_PER_SALT cuts.
        cuts = cuts.join(salts, ["lang", part], "left")
        cuts = cuts.withColumn("salt", F.pmod(F.xxhash64("phrase", "cut"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    else:
        cuts = cuts.withColumn("salt", F.lit(0))
    sums = sums.select("lang", F.col("piece").alias(part), "salt", name)
    return scratch.table(cuts.join(sums, ["lang", part, "salt"]).drop("salt"))
