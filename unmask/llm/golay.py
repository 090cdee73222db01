"""Near duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments A (23 bits), B (23) and C (18, two halves of 9). Every 23-bit
word decodes to one of 4,096 codewords of the perfect binary Golay code, and the codewords of all words
at most one bit away are its keys: one to six of them. Two words that differ in two bits or fewer have a
word one step from both, hence a key in common. Up to three wrong bits split over the segments as
(a, b, c), and in each case two fingerprints meet under one of six key kinds:

* c at most 1, a and b at most 2: a key of A, a key of B and the half of C that is intact (two kinds);
* c of 2 or 3: a + b is at most 1, so A is equal and B has a key in common, or the reverse (two kinds);
* a = 3 or b = 3: the other two segments are equal (two kinds).

Candidates are verified on the whole fingerprint, so links are exact: none missed, none wrong.

Scale: equal fingerprints are one. Keys move once and are counted where they meet; those held by a single
fingerprint are dropped there. A key with many is cut into blocks and every pair of blocks is a small task's group, which gives a spanning forest
of its links instead of all pairs. Components are found by star operations on written tables.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from unmask.llm.common import cols, fresh, quoted, shuffle_partitions
from unmask.session import Scratch, durable

SHINGLE_WORDS = 3
MAX_BITS = 3
# Fingerprints of one key that are compared in a group; a pair of blocks holds twice as many.
BLOCK = 2_000
# Row numbers that are copied to the tasks, so that texts need not move.
COPIED_ROWS = 1_000_000
_SEED = 42


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's word shingles, A-Z lower-cased; 0 without a word."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, _SEED) for s in shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row of ``docs``; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.fromiter((fingerprint(t, words) for t in batch.column(1).to_pylist()), dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


@functools.cache
def decoder() -> np.ndarray:
    """Codeword index of each of the 2**23 words: its only codeword within three bits."""
    generator = 0b101011100011
    codes = np.zeros(1, dtype=np.int64)
    for i in range(12):
        codes = np.concatenate([codes, codes ^ (generator << i)])
    one = 1 << np.arange(23)
    two = np.unique((one[:, None] ^ one).ravel())
    errors = np.unique((two[:, None] ^ np.concatenate([[0], one])).ravel())
    out = np.zeros(1 << 23, dtype=np.uint16)
    out[codes[:, None] ^ errors] = np.arange(4096, dtype=np.uint16)[:, None]
    return out


def word_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 24) codeword indices of the words one bit away or none, and which of them to take."""
    near = np.concatenate([[0], 1 << np.arange(23)])
    keys = np.sort(decoder()[words[:, None] ^ near], axis=1).astype(np.int64)
    first = np.ones(keys.shape, dtype=bool)
    first[:, 1:] = keys[:, 1:] != keys[:, :-1]
    # No word has more than six: pack them to the left.
    order = np.argsort(~first, axis=1, kind="stable")[:, :6]
    return np.take_along_axis(keys, order, 1), np.take_along_axis(first, order, 1)


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (key, fingerprint) rows of some fingerprints (unsigned)."""
    v = fps.astype(np.uint64)
    a = (v & np.uint64((1 << 23) - 1)).astype(np.int64)
    b = ((v >> np.uint64(23)) & np.uint64((1 << 23) - 1)).astype(np.int64)
    c = (v >> np.uint64(46)).astype(np.int64)
    ka, ta = word_keys(a)
    kb, tb = word_keys(b)
    both = (ka[:, :, None] << 12 | kb[:, None, :]).reshape(len(v), 36)
    took = (ta[:, :, None] & tb[:, None, :]).reshape(len(v), 36)
    yes = np.ones((len(v), 1), dtype=bool)
    kinds = [
        (both << 9 | (c & 511)[:, None], took),
        (both << 9 | (c >> 9)[:, None], took),
        (a[:, None] << 12 | kb, tb),
        (b[:, None] << 12 | ka, ta),
        ((a << 18 | c)[:, None], yes),
        ((b << 18 | c)[:, None], yes),
    ]
    keys, rows = [], []
    for kind, (k, t) in enumerate(kinds):
        keys.append((k | kind << 44)[t])
        rows.append(np.nonzero(t)[0])
    return np.concatenate(keys), fps[np.concatenate(rows)]


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, fps = fuzzy_keys(batch.column(0).to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps.view(np.int64))], names=["key", "fp"])


def spanning_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links (as positions) that connect what any links of at most ``max_bits`` bits connect."""
    left, out = np.arange(1, len(fps)), []
    open_ = [0]
    while left.size:
        if not open_:
            open_, left = [left[0]], left[1:]
            continue
        p = open_.pop()
        near = np.bitwise_count(fps[left] ^ fps[p]) <= max_bits
        found = left[near].tolist()
        out += [(p, x) for x in found]
        open_ += found
        left = left[~near]
    return out


def _links(max_bits: int):
    """Verified links of sorted groups (key, lo, hi); a group may go on in the next batch."""

    def of(groups: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.r_[True, (groups[1:] != groups[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[starts, len(fps)])
        two = starts[sizes == 2]
        two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= max_bits]
        us, vs = [fps[two]], [fps[two + 1]]
        for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            own = fps[at : at + n]
            if pairs := spanning_links(own, max_bits):
                x, y = np.array(pairs).T
                us.append(own[x])
                vs.append(own[y])
        return np.concatenate(us), np.concatenate(vs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_g, held_f = np.zeros((0, 3), dtype=np.int64), np.zeros(0, dtype=np.uint64)

        def done(g: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            u, v = of(g, f)
            pairs = np.unique(np.stack([u.view(np.int64), v.view(np.int64)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs.max(axis=1)), pa.array(pairs.min(axis=1))], names=["u", "v"]
            )

        for batch in batches:
            g = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            g = np.concatenate([held_g, g])
            f = np.concatenate([held_f, batch.column(3).to_numpy().view(np.uint64)])
            if not len(f):
                continue
            last = np.flatnonzero((g != g[-1]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0
            held_g, held_f = g[cut:], f[cut:]
            if cut:
                yield done(g[:cut], f[:cut])
        if len(held_f):
            yield done(held_g, held_f)

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(u, v) links among distinct fingerprints ``fp`` that join all those within ``max_bits`` bits."""
    if max_bits > 3:
        raise ValueError("the key kinds cover three bits")
    keys = fps.mapInArrow(_expand, "key long, fp long")
    shared = keys.withColumn("n", F.count("*").over(W.partitionBy("key"))).filter("n > 1")
    blocks = F.ceil(F.col("n") / block)
    rows = shared.select("key", "fp", blocks.alias("blocks"), F.pmod(F.xxhash64("fp"), blocks).alias("own"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    grouped = rows.repartition(shuffle_partitions(fps.sparkSession), "key", "lo", "hi")
    return grouped.sortWithinPartitions("key", "lo", "hi").mapInArrow(_links(max_bits), "u long, v long").distinct()


def connected(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, by large and small stars."""

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
        if large:
            both = both.union(both.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("low"))
        out = both.join(low, "x")
        if large:
            out = out.filter("y > x").select(F.col("y").alias("u"), F.col("low").alias("v"))
        else:
            out = out.select(F.col("y").alias("u"), F.col("low").alias("v")).union(
                low.select(F.col("x").alias("u"), F.col("low").alias("v"))
            )
        return out.filter("u > v").distinct()

    def state(edges: DataFrame) -> tuple:
        mix = F.xxhash64("u", "v")
        sums = (F.sum(F.shiftright(mix, 32)), F.sum(mix.bitwiseAND(0xFFFFFFFF)))
        return tuple(edges.agg(F.count("*"), *sums).first())

    edges = scratch.table(links.filter("u > v"))
    seen = None
    while (now := state(edges)) != seen:
        seen = now
        edges = scratch.table(star(scratch.table(star(edges, True)), False))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def fingerprint_roots(fps: DataFrame, max_bits: int, scratch: Scratch) -> DataFrame:
    """(fp, root): the smallest fingerprint that each of some distinct ones reaches through links."""
    roots = scratch.table(connected(fingerprint_links(fps, max_bits), scratch))
    return fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text; other columns are not read).

    Fingerprints that differ in ``max_bits`` bits or fewer are linked, and component_id is the smallest
    doc_id that a document reaches through links, its own included. A null text is an empty one, and
    texts without a word have fingerprint 0, linked like any other. Repeated rows stay repeated. Rows
    without doc_id keep a null doc_id and take part; component_id is null where no member has one.
    """
    spark = docs.sparkSession
    rows = durable(fingerprints(docs, words), "fingerprints")
    with Scratch(spark, "near-duplicates") as scratch:
        distinct = scratch.table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
        rooted = scratch.table(fingerprint_roots(distinct.select("fp"), max_bits, scratch).join(distinct, "fp"))
        lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        parts = durable(rooted.join(lowest, "root").select("fp", "component_id"), "components")
    return rows.join(parts, "fp").select("doc_id", "fp", "component_id")


def first_of_groups(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near duplicates in ``docs`` (doc_id, text and any others).

    Groups are those of ``near_duplicates``; the row with the least doc_id stays, of equal ids (and where
    no row has one) the first in the order read. A row in no other's group always stays, whatever its id.
    """
    fp, uid = fresh(docs, "_fp"), fresh(docs, "_row")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = np.fromiter((fingerprint(t, words) for t in texts.to_pylist()), dtype=np.uint64, count=len(texts))
            yield pa.array(out.view(np.int64))

    marked = docs.withColumn(fp, F.arrow_udf(run, "long")(quoted("text").cast("string")))
    marked = durable(marked.withColumn(uid, F.monotonically_increasing_id()), "marked")
    with Scratch(docs.sparkSession, "near-duplicates") as scratch:
        doc_id = quoted("doc_id").cast("long")
        first = F.min(F.struct(doc_id.isNull().alias("none"), doc_id.alias("doc_id"), quoted(uid).alias("uid")))
        # One row a fingerprint before anything is joined, so that many copies are no hot key.
        distinct = scratch.table(marked.groupBy(quoted(fp).alias("fp")).agg(first.alias("first")))
        rooted = fingerprint_roots(distinct.select("fp"), max_bits, scratch).join(distinct, "fp")
        chosen = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.uid").alias("uid"))
        chosen = durable(chosen, "chosen")
        # Only numbers move to tell which rows go; the shorter of both lists meets the texts.
        others = durable(marked.select(quoted(uid).alias("uid")).join(chosen, "uid", "left_anti"), "others")
    n_chosen, n_others = chosen.count(), others.count()
    few, how = (others, "left_anti") if n_others < n_chosen else (chosen, "left_semi")
    few = F.broadcast(few) if min(n_others, n_chosen) <= COPIED_ROWS else few
    return marked.join(few, quoted(uid) == few["uid"], how).select(*cols(docs))
