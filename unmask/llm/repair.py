"""Token ids in binary shards, compressed by Re-Pair grammars.

A shard file is Parquet with one row for each block of whole documents in ascending doc_id order.
Within a block, frequent pairs of neighbouring symbols are replaced by new symbols again and again, as
long as that shortens it; all frequent pairs of a round are replaced together, the more frequent first
where they overlap. A row holds:

* ``part``, ``block``: file part and number within it; their order is the order of the ids;
* ``base``: symbols from here on are rules; ``width``: bytes of a stored symbol (2 or 4);
* ``rules``: left and right symbol of each rule (unsigned 32-bit), an earlier rule or an id;
* ``rule_tokens``: tokens that each rule expands to (unsigned 32-bit);
* ``symbols``: the block's symbols; ``every``: tokens before each 1,024th symbol (unsigned 64-bit);
* ``doc_ids``, ``doc_tokens``: the block's documents and their token counts; ``n_tokens``: their sum.

``decode_range`` follows the lengths of rules down to the tokens of a range and expands nothing else. All
numbers are little-endian.

A block's grammar ends where no pair occurs ``MIN_COUNT`` times, where a round would shorten the block by no
more than ``MIN_GAIN``, or where the symbols of two bytes are used up.

Scale: documents are range-partitioned by doc_id; a task holds a block at a time, which is bounded by
``block_tokens`` and its last document. Positions before a block are sums over parts, then blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from unmask.llm.common import shuffle_partitions
from unmask.llm.tokens import WIDE_STORE_BYTES, json_encoder, slices

BLOCK_TOKENS = 1 << 20
MIN_COUNT = 64
ROUND_RULES = 4_096
# A round that would shorten a block by no more than this share ends it.
MIN_GAIN = 0.001
SAMPLE = 1_024
_BUCKET_BITS = 18

SCHEMA = (
    "part int, block int, n_tokens long, base long, width int, rules binary, rule_tokens binary, symbols binary, "
    "every binary, doc_ids array<long>, doc_tokens array<long>"
)


def compress(ids: np.ndarray, min_count: int = MIN_COUNT, max_rules: int | None = None) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(base, rules (n, 2), tokens of each rule, symbols) of a grammar that expands to ``ids``."""
    base = int(ids.max()) + 1 if len(ids) else 1
    if max_rules is None:
        # Symbols stay within two bytes where the ids do.
        max_rules = (1 << 16) - base if base < 1 << 16 else 1 << 24
    s = ids.astype(np.uint32)
    rules, tokens = [np.zeros((0, 2), dtype=np.uint32)], [np.zeros(0, dtype=np.uint32)]
    made, turn = 0, 0
    while len(s) > 1 and made < max_rules:
        turn += 1
        # Pairs are counted in hash buckets, with another hash in every round. A full bucket stands for
        # the pair of one of its places; others that fell into it wait for a later round.
        a, b = (np.uint32((turn * k) & 0xFFFFFFFF | 1) for k in (0x9E3779B1, 0x85EBCA77))
        bucket = ((s[:-1] * a + (s[1:] ^ (s[1:] >> np.uint32(7))) * b) >> np.uint32(32 - _BUCKET_BITS)).astype(np.intp)
        per_bucket = np.bincount(bucket, minlength=1 << _BUCKET_BITS)
        level = max(min_count, int(np.partition(per_bucket, -ROUND_RULES)[-ROUND_RULES]))
        at = np.flatnonzero((per_bucket >= level)[bucket])
        if not len(at):
            break
        group = bucket[at]
        example = np.zeros(1 << _BUCKET_BITS, dtype=np.int64)
        example[group] = at
        example = example[group]
        alike = (s[at] == s[example]) & (s[at + 1] == s[example + 1])
        at, group, example = at[alike], group[alike], example[alike]
        counts = np.bincount(group, minlength=1 << _BUCKET_BITS)
        full = np.flatnonzero(counts >= min_count)
        # The more frequent go first where pairs overlap; equal counts by bucket.
        full = full[np.argsort(-counts[full], kind="stable")][: min(ROUND_RULES, max_rules - made)]
        rank = np.zeros(1 << _BUCKET_BITS, dtype=np.int32)
        rank[full] = np.arange(len(full), 0, -1)
        here = np.zeros(len(s) + 1, dtype=np.int32)
        here[at + 1] = rank[group]
        own = here[1:-1]
        taken = (own > 0) & (own >= here[:-2]) & (own >= here[2:])
        # A pair of one symbol may overlap itself: of such a run every other place is taken.
        again = np.flatnonzero((own == here[:-2]) & (own > 0))
        if len(again):
            head = np.maximum.accumulate(np.where(np.diff(again, prepend=-2) > 1, again - 1, 0))
            taken[again[(again - head) % 2 == 1]] = False
        at = np.flatnonzero(taken)
        if len(at) <= MIN_GAIN * len(s):
            break
        # The pairs that were taken are numbered anew, the more frequent first.
        number = len(full) - own[at]
        first = np.full(len(full), -1, dtype=np.int64)
        first[number] = at
        used = np.flatnonzero(first >= 0)
        first = first[used]
        new = np.zeros(len(full), dtype=np.int64)
        new[used] = np.arange(len(used))
        pair = np.stack([s[first], s[first + 1]], axis=1)
        known = np.concatenate(tokens)
        size = np.where(pair < base, 1, known[np.maximum(pair.astype(np.int64) - base, 0)] if len(known) else 1)
        rules.append(pair)
        tokens.append(size.sum(axis=1).astype(np.uint32))
        s[at] = (base + made + new[number]).astype(np.uint32)
        stays = np.ones(len(s), dtype=bool)
        stays[at + 1] = False
        s = s[stays]
        made += len(used)
    return base, np.concatenate(rules), np.concatenate(tokens), s


def expand(symbols: np.ndarray, base: int, rules: np.ndarray) -> np.ndarray:
    """Ids that symbols stand for, copied out of a table of all rules' expansions."""
    if not len(rules):
        return symbols.astype(np.uint32)
    ids = np.arange(base, dtype="<u4")
    spelled: list[bytes] = []
    for left, right in rules.tolist():
        first = ids[left].tobytes() if left < base else spelled[left - base]
        spelled.append(first + (ids[right].tobytes() if right < base else spelled[right - base]))
    table = np.concatenate([ids, np.frombuffer(b"".join(spelled), dtype="<u4")])
    size = np.concatenate([np.ones(base, dtype=np.int64), [len(x) // 4 for x in spelled]])
    place = np.concatenate([[0], np.cumsum(size)[:-1]])
    n = size[symbols]
    ends = np.cumsum(n)
    return table[np.repeat(place[symbols] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


class Block:
    """A stored block, opened for reading."""

    def __init__(self, row: dict):
        self.base, self.n_tokens = row["base"], row["n_tokens"]
        self.rules = np.frombuffer(row["rules"], dtype="<u4").reshape(-1, 2)
        self.rule_tokens = np.frombuffer(row["rule_tokens"], dtype="<u4")
        self.symbols = np.frombuffer(row["symbols"], dtype=f"<u{row['width']}")
        self.every = np.frombuffer(row["every"], dtype="<u8")
        # Rules that the last range has opened.
        self.opened = 0

    def decode(self) -> np.ndarray:
        return expand(self.symbols, self.base, self.rules)

    def decode_range(self, start: int, n: int) -> np.ndarray:
        """Tokens start .. start+n-1, from the symbols that hold them."""
        n = min(n, self.n_tokens - start)
        if n <= 0:
            return np.zeros(0, dtype=np.uint32)
        first = int(np.searchsorted(self.every, start, side="right")) - 1
        last = int(np.searchsorted(self.every, start + n, side="left"))
        some = self.symbols[first * SAMPLE : last * SAMPLE]
        ends = int(self.every[first]) + np.cumsum(_symbol_tokens(some, self.base, self.rule_tokens))
        a = int(np.searchsorted(ends, start, side="right"))
        b = int(np.searchsorted(ends, start + n, side="left")) + 1
        before = int(ends[a - 1]) if a else int(self.every[first])
        return self._spell(some[a:b], start - before, n)

    def _spell(self, symbols: np.ndarray, skip: int, n: int) -> np.ndarray:
        """``n`` tokens of some symbols after the first ``skip``: rules outside of the range stay closed."""
        out, stack = [], symbols[::-1].astype(np.int64).tolist()
        self.opened = 0
        while stack and len(out) < n:
            symbol = stack.pop()
            if symbol < self.base:
                if skip:
                    skip -= 1
                else:
                    out.append(symbol)
                continue
            size = int(self.rule_tokens[symbol - self.base])
            if skip >= size:
                skip -= size
                continue
            self.opened += 1
            left, right = self.rules[symbol - self.base].tolist()
            stack += [right, left]
        return np.array(out, dtype=np.uint32)


def _symbol_tokens(symbols: np.ndarray, base: int, rule_tokens: np.ndarray) -> np.ndarray:
    out = np.ones(len(symbols), dtype=np.uint64)
    rule = symbols >= base
    out[rule] = rule_tokens[symbols[rule].astype(np.int64) - base]
    return out


def _row(part: int, block: int, docs: list[int | None], packed: list[bytes]) -> dict:
    ids = np.frombuffer(b"".join(packed), dtype="<u4")
    base, rules, rule_tokens, symbols = compress(ids)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    ends = np.cumsum(_symbol_tokens(symbols, base, rule_tokens))
    every = np.concatenate([[0], ends[SAMPLE - 1 : -1 : SAMPLE]]).astype("<u8")
    return {
        "part": part, "block": block, "n_tokens": len(ids), "base": base, "width": width, "rules": rules.astype("<u4").tobytes(),
        "rule_tokens": rule_tokens.astype("<u4").tobytes(), "symbols": symbols.astype(f"<u{width}").tobytes(),
        "every": every.tobytes(), "doc_ids": docs, "doc_tokens": [len(p) // 4 for p in packed],
    }


def write_shards(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, block_tokens: int = BLOCK_TOKENS
) -> None:
    """Encode every text of ``docs`` (doc_id, text; other columns are not read) and write the shards.

    Documents are in ascending order of doc_id, null first; rows with equal ids follow one another. A
    null text is an empty one, whose only token is the end id. An empty table writes no block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = json_encoder(vocabulary, WIDE_STORE_BYTES), np.array([end_id], dtype="<u4").tobytes()
        part, block, keys, packed, held = 0, 0, [], [], 0

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_row(part, block, keys, packed)], schema=fields)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            part = batch.column(2)[0].as_py() if len(ids) else part
            for a, b in slices(texts, 4_000_000):
                for i, p in enumerate(encoder.encode(texts[a:b]), a):
                    keys.append(ids[i])
                    packed.append(p + end)
                    held += len(p) // 4 + 1
                    if held >= block_tokens:
                        yield full()
                        block, keys, packed, held = block + 1, [], [], 0
        if keys:
            yield full()
        encoder.rest()

    fields = pa.schema([
        ("part", pa.int32()), ("block", pa.int32()), ("n_tokens", pa.int64()), ("base", pa.int64()), ("width", pa.int32()),
        *((n, pa.binary()) for n in ("rules", "rule_tokens", "symbols", "every")),
        ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
    ])
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("tie"),
    )
    parts = shuffle_partitions(docs.sparkSession)
    ordered = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "text", F.spark_partition_id()).mapInArrow(run, SCHEMA).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the shards; ids as unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = Block(row).decode().astype("<u4").tobytes()
                counts = row["doc_tokens"]
                ends = np.cumsum(counts)
                starts = ends - counts
                ids = [data[4 * x : 4 * y] for x, y in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["before"] + starts), pa.array(counts, pa.int64()),
                    pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    blocks = spark.read.schema(SCHEMA).parquet(path)
    sums = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("part", earlier.alias("earlier"))
    within = W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    places = blocks.select("part", "block", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("within"))
    places = places.join(sums, "part").select("part", "block", (F.col("earlier") + F.col("within")).alias("before"))
    return blocks.join(places, ["part", "block"]).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
