"""Texts cut into words and pieces by byte tables, a slice of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A byte that no UTF-8 text holds stands between texts.
_BETWEEN = 0xFF
SPACE, BREAK = 0x20, 0x0A
SLICE_CHARS = 4_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; no other character changes."""
    return F.translate(text, _UPPER, _LOWER)


def byte_table(spaces: bytes, breaks: bytes = b"") -> bytes:
    """A translation of UTF-8 bytes: A-Z in lower case, ``spaces`` to the space, ``breaks`` to the break."""
    table = bytearray(range(256))
    table[0x41:0x5B] = _LOWER.encode()
    for b in spaces:
        table[b] = SPACE
    for b in breaks:
        table[b] = BREAK
    return bytes(table)


@dataclass
class Words:
    """The words of some texts, one after another: ``code`` names a word in ``names`` (distinct bytes)."""

    code: np.ndarray
    names: pa.Array
    doc: np.ndarray
    piece: np.ndarray

    def hashes(self) -> np.ndarray:
        """XXH64 (seed 42) of each name: what xxhash64 of Spark gives, unsigned."""
        return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in self.names.to_pylist()), dtype=np.uint64, count=len(self.names))


def split_words(texts: list[str | None], table: bytes) -> Words:
    """Words are runs of bytes other than space and break; pieces end at breaks and at the texts' ends."""
    data = b"\xff".join(t.encode("utf-8", "surrogatepass") if t else b"" for t in texts).translate(table)
    a = np.frombuffer(data, dtype=np.uint8)
    between = a == _BETWEEN
    ends_piece = between | (a == BREAK)
    inside = ~(ends_piece | (a == SPACE))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    kind, width = (pa.binary(), np.int32) if offsets[-1] < 1 << 31 else (pa.large_binary(), np.int64)
    buffers = [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(a[inside])]
    found = pa.Array.from_buffers(kind, len(starts), buffers).dictionary_encode()
    doc = np.searchsorted(np.flatnonzero(between), starts)
    piece = np.searchsorted(np.flatnonzero(ends_piece), starts)
    return Words(found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary, doc, piece)


def text_slices(batch: pa.RecordBatch, column: int = 0, chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """A batch cut where about ``chars`` bytes of text are full; a longer text is a slice of its own."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    start = held = 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


BITS = 25


class Bitmap:
    """A set of 64-bit hashes as a bitmap of fixed size: it may say yes to others, never no to its own."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, hashes: DataFrame, column: str = "h", bits: int = BITS) -> Bitmap:
        """Of a long column. At most 2**bits / 64 rows come to the driver, however many hashes there are."""
        place = F.shiftrightunsigned(F.col(column), 64 - bits).alias("place")
        bit = F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit")
        rows = hashes.select(place).select(F.shiftright("place", 6).alias("at"), bit)
        found = rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
        words = np.zeros(1 << (bits - 6), dtype=np.uint64)
        words[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
        return cls(words)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        bits = len(self.words).bit_length() - 1 + 6
        place = hashes >> np.uint64(64 - bits)
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
