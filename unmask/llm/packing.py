"""Best-fit decreasing packing of token sequences.

Documents longer than a window are first cut into full windows and a rest. Rests are placed in
decreasing length, each into the open window with the least room that still takes it. Windows with
equal room are alike, and so are pieces of equal length, so the packing is found on counts: a stack of
window ranges for each room, and a segment tree over the rooms that finds the tightest one in use. The
outcome is a list of ranges "the next n pieces of this length go to windows w, w+1, ... at this offset",
which does not depend on how many pieces there are: lengths are below the window, so the counts that
reach the driver are window - 1 rows at most.

Scale: one pass encodes the texts. Pieces are then numbered within their length, by pieces of the hash
range, and find their window by a join on (length, cell of numbers). No task holds a length or a window.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unmask.llm.common import prefix_sums
from unmask.llm.tokens import json_encoder, slices
from unmask.session import Scratch, durable

WINDOW = 4_096
# Pieces of one length that are numbered in one task.
PIECE_ROWS = 20_000


class RoomTree:
    """Segment tree over rooms 0 .. size-1: which are in use, and the smallest in use from a value on."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves < size:
            self.leaves *= 2
        self.used = [False] * (2 * self.leaves)

    def mark(self, room: int, used: bool) -> None:
        node = room + self.leaves
        self.used[node] = used
        while node > 1:
            node //= 2
            self.used[node] = self.used[2 * node] or self.used[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        """Smallest room in use that is at least ``least``."""
        node = least + self.leaves
        if least >= self.leaves:
            return None
        while not self.used[node]:
            # Up to the first subtree on the right, unless this is the end.
            while node & 1:
                node //= 2
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not self.used[node]:
                node += 1
        return node - self.leaves


def best_fit_decreasing(counts: dict[int, int], window: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Ranges (length, first, n, window number, offset) for pieces ``first .. first+n-1`` of a length,
    one to each window from that number on; and the number of windows used."""
    tree = RoomTree(window + 1)
    stacks: dict[int, list[tuple[int, int]]] = {}
    ranges, opened = [], 0

    def put(room: int, start: int, n: int) -> None:
        if not stacks.get(room):
            stacks[room] = []
            tree.mark(room, True)
        stacks[room].append((start, n))

    for length in sorted(counts, reverse=True):
        left, done = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                # Every further piece opens windows; a window that takes several is filled at once.
                start, n, room = opened, -(-left // (window // length)), window
                opened += n
            else:
                start, n = stacks[room].pop()
                if not stacks[room]:
                    tree.mark(room, False)
            # The tightest window stays the tightest while it has room for one more piece.
            each = room // length
            full = min(n, left // each)
            if full:
                for j in range(each):
                    # Pieces are dealt window by window; which of equal pieces goes where is free.
                    ranges.append((length, done + j * full, full, start, window - room + j * length))
                put(room - each * length, start, full)
                done, left, start, n = done + each * full, left - each * full, start + full, n - full
            if left and n:
                for j in range(left):
                    ranges.append((length, done + j, 1, start, window - room + j * length))
                put(room - left * length, start, 1)
                start, n, left = start + 1, n - 1, 0
            if n:
                put(room, start, n)
    return ranges, opened


class Packing(NamedTuple):
    """``pieces``: (row, doc_id, doc_tokens, start, length, ids, piece_id), ids as little-endian unsigned 32-bit
    integers, row the same for the pieces of one row of the input; ``places``: (piece_id, sequence_id, offset).

    Where ``narrow``, a piece whose ids fit takes two bytes for each until it has its place."""

    pieces: DataFrame
    places: DataFrame
    narrow: bool = False

    def placed(self, *columns: Column | str) -> DataFrame:
        """Pieces with their places; ``columns`` (all by default) are taken before the join."""
        chosen = self.pieces.select("piece_id", *columns) if columns else self.pieces
        out = chosen.join(self.places, "piece_id").drop("piece_id")
        return out.mapInArrow(widened, out.schema) if self.narrow and "ids" in out.columns else out


def widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose ids take four bytes each again; ``length`` says how many there are."""
    for batch in batches:
        pairs = zip(batch.column("ids").to_pylist(), batch.column("length").to_pylist(), strict=True)
        ids = [x if len(x) == 4 * n else np.frombuffer(x, dtype="<u2").astype("<u4").tobytes() for x, n in pairs]
        at = batch.schema.get_field_index("ids")
        yield batch.set_column(at, batch.schema.field(at), pa.array(ids, pa.binary()))


def narrowed(packed: bytes) -> bytes:
    """Ids of four bytes as ids of two, if none is too large."""
    ids = np.frombuffer(packed, dtype="<u4")
    return ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else packed


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, window: int, narrow: bool = False) -> DataFrame:
    """(row, doc_id, doc_tokens, start, length, ids) of every piece: full windows, then the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = json_encoder(vocabulary)
        end = np.array([end_id], dtype="<u4").tobytes()
        names = ["row", "doc_id", "doc_tokens", "start", "length", "ids"]
        for batch in batches:
            keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                which, totals, starts, ids = [], [], [], []
                for i, packed in enumerate(encoder.encode(texts[a:b]), a):
                    packed += end
                    for at in range(0, len(packed), 4 * window):
                        which.append(i)
                        totals.append(len(packed) // 4)
                        starts.append(at // 4)
                        ids.append(packed[at : at + 4 * window])
                longs = [pa.array(x, pa.int64()) for x in (totals, starts, [len(x) // 4 for x in ids])]
                ids = list(map(narrowed, ids)) if narrow else ids
                columns = [batch.column(2).take(pa.array(which)), keys.take(pa.array(which)), *longs, pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        encoder.rest()

    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.monotonically_increasing_id())
    return pairs.mapInArrow(run, "row long, doc_id long, doc_tokens long, start long, length long, ids binary")


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, window: int = WINDOW, narrow: bool = False) -> Packing:
    """Every piece of every document, and its place in a sequence of at most ``window`` tokens.

    ``docs`` has doc_id and text; other columns are not read. A null text is an empty one, whose only
    token is the end id. Rows are packed one by one, so repeated rows and ids, or null ids, do no harm. An
    empty table gives an empty result. Sequences are numbered without gaps: windows shared by rests
    first, then the full ones; a sequence shorter than the window is padded to it. ``narrow`` is for
    callers that take the ids along with the places: less is written and moved.
    """
    spark = docs.sparkSession
    encoded = token_pieces(docs, vocabulary, end_id, window, narrow)
    pieces = durable(encoded.withColumn("piece_id", F.monotonically_increasing_id()), "pieces")
    sizes = pieces.select("piece_id", "length")
    # At most one row for each length, and lengths are at most the window.
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.count("*").alias("n")).collect()}
    parts = max(1, max(counts.values(), default=0) // PIECE_ROWS)
    full = counts.pop(window, 0)
    ranges, used = best_fit_decreasing(counts, window)
    if full:
        ranges.append((window, 0, full, used, 0))
        counts[window] = full
    # A length's numbers lie in cells, about one for each of its ranges; a range is entered under all it touches.
    split = Counter(r[0] for r in ranges)
    width = {n: -(-c // split[n]) for n, c in counts.items()}
    entries = [
        (n, c, first, first + many, w - first, offset)
        for n, first, many, w, offset in ranges
        for c in range(first // width[n], (first + many - 1) // width[n] + 1)
    ]
    # Both tables depend on the window alone, so they are broadcast at any size of input.
    widths = spark.createDataFrame(list(width.items()), "length long, width long")
    found = spark.createDataFrame(entries, "length long, cell long, lo long, hi long, shift long, offset long")
    with Scratch(spark, "packing") as scratch:
        part = F.pmod(F.xxhash64("piece_id"), F.lit(parts))
        rows = sizes.select("piece_id", "length", part.alias("part"), F.lit(1).cast("long").alias("one"))
        numbered = prefix_sums(scratch.table(rows), ["length"], "part", ["piece_id"], "one", "k")
        celled = numbered.join(F.broadcast(widths), "length").withColumn("cell", F.expr("k div width"))
        places = celled.join(F.broadcast(found), ["length", "cell"]).filter("k >= lo and k < hi")
        places = places.select("piece_id", (F.col("k") + F.col("shift")).alias("sequence_id"), "offset")
        return Packing(pieces, durable(places, "places"), narrow)
