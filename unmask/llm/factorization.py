"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector x: its words hashed to ``BUCKETS`` places (logarithms of counts, scaled to
length one) and a few dense figures of its structure (shares of character classes, repeated neighbours,
distinct words, lines) and of its metadata (length, share of characters beyond ASCII). The score is

    sigmoid(w0 + w.x + sum over pairs i < j of <v_i, v_j> x_i x_j)

and the pairs cost linear time: half the sum over factors of (sum v_i x_i)^2 - sum (v_i x_i)^2.

Labels, language, source and doc_id are no inputs of a score. The model is fitted on at most ``SAMPLE``
labelled documents, those whose ids hash lowest, in one task that holds ``SAMPLE`` vectors of at most
``BUCKETS`` places; everything else covers all rows.

Scale: scoring is one pass, row by row, without a shuffle; the model has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unmask.llm.common import cols, fresh, quoted
from unmask.llm.split import Words, byte_table, split_words, text_slices
from unmask.session import Scratch

BUCKETS = 1 << 12
FACTORS = 8
SAMPLE = 10_000
EPOCHS = 20
BATCH = 128
RATE = 0.1
SHRINK = 1e-5
THRESHOLD = 0.7
SEED = 13
_TABLE = byte_table(b" \t\x0b\x0c\r", b"\n")

# Classes of bytes that the structure statistics count.
_OTHER, _SPACE, _LOWER, _UPPER, _DIGIT, _MARK, _CALL, _BAR, _SYMBOL, _BEYOND = range(10)
_CLASS = np.full(256, _OTHER, dtype=np.int64)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = _MARK
_CLASS[[ord(c) for c in "!?"]] = _CALL
_CLASS[ord("|")] = _BAR
_CLASS[[ord(c) for c in "#*$%&<>@^~=+_{}[]\\/"]] = _SYMBOL
_CLASS[128:] = _BEYOND
FIGURES = (
    "upper share", "digits", "marks a word", "calls a word", "bars a word", "symbols a word", "beyond ASCII", "other characters",
    "neighbours repeated", "distinct words", "lines repeated", "words a line", "characters a word", "logarithm of the length", "empty",
)


def structure(texts: list[str | None], words: Words) -> np.ndarray:
    """(texts, FIGURES): dense statistics, each about between 0 and 1."""
    docs = len(texts)
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    size = np.array([len(t) for t in raw], dtype=np.int64)
    of = np.repeat(np.arange(docs), size)
    per_class = np.bincount(of * 10 + _CLASS[np.frombuffer(b"".join(raw), dtype=np.uint8)], minlength=docs * 10).reshape(docs, 10).astype(float)
    share = lambda a, b: a / np.maximum(b, 1)
    count = lambda where: np.bincount(where, minlength=docs).astype(float)
    n = count(words.doc)
    same = (words.code[1:] == words.code[:-1]) & (words.doc[1:] == words.doc[:-1])
    pairs = np.unique(words.doc * (len(words.names) + 1) + words.code) // (len(words.names) + 1)
    starts = np.flatnonzero(np.diff(words.piece, prepend=-1))
    line_doc = words.doc[starts]
    # A line is named by a sum over its words that depends on their places; an accident would shift one figure.
    place = np.arange(len(words.code)) - np.repeat(starts, np.diff(np.append(starts, len(words.code))))
    named = words.hashes()[words.code] * (2 * place.astype(np.uint64) + np.uint64(1))
    line = np.add.reduceat(named, starts) if len(starts) else np.zeros(0, np.uint64)
    distinct_lines = count(np.unique(np.stack([line_doc.astype(np.uint64), line]), axis=1)[0].astype(np.int64)) if len(line) else np.zeros(docs)
    lines, inside = count(line_doc), per_class.sum(1) - per_class[:, _SPACE]
    letters = per_class[:, _LOWER] + per_class[:, _UPPER] + per_class[:, _BEYOND]
    return np.stack([
        share(per_class[:, _UPPER], letters), share(per_class[:, _DIGIT], inside),
        *(np.minimum(share(per_class[:, c], n), 2) for c in (_MARK, _CALL, _BAR, _SYMBOL)),
        share(per_class[:, _BEYOND], inside), share(per_class[:, _OTHER], inside),
        share(count(words.doc[1:][same]), n), share(count(pairs), n), 1 - share(distinct_lines, lines) * (lines > 0) - (lines == 0),
        np.minimum(share(n, lines) / 100, 2), np.minimum(share(inside, n) / 10, 2), np.log1p(size) / 12, (n == 0).astype(float),
    ], axis=1)


@dataclass
class Vectors:
    """Some documents: dense figures, and for each (doc, bucket) of their words a value."""

    dense: np.ndarray
    doc: np.ndarray
    bucket: np.ndarray
    value: np.ndarray


def vectors(texts: list[str | None], buckets: int = BUCKETS) -> Vectors:
    words = split_words(texts, _TABLE)
    of_name = (words.hashes() % np.uint64(buckets)).astype(np.int64)
    key, times = np.unique(words.doc * buckets + of_name[words.code], return_counts=True)
    doc, bucket = np.divmod(key, buckets)
    value = np.log1p(times)
    length = np.sqrt(np.bincount(doc, weights=value * value, minlength=len(texts)))
    return Vectors(structure(texts, words), doc, bucket, value / length[doc])


class Machine:
    """Weights of the dense figures come first, then those of the buckets."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    @classmethod
    def new(cls, buckets: int = BUCKETS, factors: int = FACTORS, seed: int = SEED) -> Machine:
        n = len(FIGURES) + buckets
        return cls(0.0, np.zeros(n), np.random.default_rng(seed).normal(0, 0.05, (n, factors)))

    def parts(self, x: Vectors) -> tuple[np.ndarray, np.ndarray]:
        """(raw scores, sums of v_i x_i by document and factor)."""
        d, docs = len(FIGURES), len(x.dense)
        add = lambda values: np.bincount(x.doc, weights=values, minlength=docs)
        v = self.v[d:][x.bucket] * x.value[:, None]
        sums = x.dense @ self.v[:d] + np.stack([add(v[:, f]) for f in range(v.shape[1])], axis=1)
        squares = (x.dense**2) @ (self.v[:d] ** 2).sum(1) + add((v * v).sum(1))
        linear = x.dense @ self.w[:d] + add(self.w[d:][x.bucket] * x.value)
        return self.w0 + linear + ((sums * sums).sum(1) - squares) / 2, sums

    def score(self, x: Vectors) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.parts(x)[0], -30, 30)))

    def fit(self, x: Vectors, label: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Machine:
        """Logistic loss by mini-batches with steps scaled by past gradients, in an order that the seed gives."""
        d, n, rng = len(FIGURES), len(self.w), np.random.default_rng(seed)
        base = np.clip(label.mean() if len(label) else 0.5, 1e-3, 1 - 1e-3)
        self.w0 = float(np.log(base / (1 - base)))
        first = np.searchsorted(x.doc, np.arange(len(label) + 1))
        past_w, past_v, past_0 = np.full(n, 1e-8), np.full(self.v.shape, 1e-8), 1e-8
        for _ in range(epochs if len(set(label.tolist())) > 1 else 0):
            order = rng.permutation(len(label))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                count = first[rows + 1] - first[rows]
                take = np.repeat(first[rows] - np.cumsum(count) + count, count) + np.arange(count.sum())
                part = Vectors(x.dense[rows], np.repeat(np.arange(len(rows)), count), x.bucket[take], x.value[take])
                raw, sums = self.parts(part)
                error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[rows]) / len(rows)
                e = error[part.doc] * part.value
                gather = lambda values: np.bincount(part.bucket, weights=values, minlength=n - d)  # noqa: B023, E731
                g_w = np.concatenate([error @ part.dense, gather(e)]) + SHRINK * self.w
                own = gather(e * part.value)[:, None] * self.v[d:]
                cross = np.stack([gather(e * sums[part.doc, f]) for f in range(self.v.shape[1])], axis=1)
                dense = part.dense.T @ (error[:, None] * sums) - ((part.dense**2).T @ error)[:, None] * self.v[:d]
                g_v = np.concatenate([dense, cross - own]) + SHRINK * self.v
                g_0 = float(error.sum())
                past_w += g_w * g_w
                past_v += g_v * g_v
                past_0 += g_0 * g_0
                self.w -= RATE * g_w / np.sqrt(past_w)
                self.v -= RATE * g_v / np.sqrt(past_v)
                self.w0 -= RATE * g_0 / np.sqrt(past_0)
        return self

    def packed(self) -> bytes:
        return np.concatenate([[self.w0, self.v.shape[1]], self.w, self.v.ravel()]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Machine:
        x = np.frombuffer(data)
        factors, rest = int(x[1]), x[2:]
        n = len(rest) // (factors + 1)
        return cls(float(x[0]), rest[:n], rest[n:].reshape(n, factors))


def _chosen(docs: DataFrame, labels: DataFrame, label: str, train: Column, sample: int) -> DataFrame:
    """(h, label, text): the labelled training documents whose ids hash lowest, at most ``sample``.

    An id with several labels has the least of them, an id with several texts the one that hashes lowest.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & train)
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    known = known.withColumn("h", F.xxhash64("doc_id"))
    # Ids without a document take no place in the sample.
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    here = found.select("doc_id").join(known, "doc_id", "left_semi").distinct()
    known = known.join(here, "doc_id").orderBy("h", "doc_id").limit(sample)
    rows = found.join(F.broadcast(known), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("tie"), "text")).alias("row")
    return rows.groupBy("doc_id", "h", "label").agg(one).select("doc_id", "h", "label", F.col("row.text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, label: str, rows: Column, sample: int = SAMPLE, epochs: int = EPOCHS) -> Machine:
    """A machine fitted on labelled documents (doc_id, text; doc_id, ``label``) for whose doc_id ``rows`` holds.

    Without a label, or with one class only, every document scores alike.
    """
    schema = "h long, doc_id long, label int, dense array<double>, bucket array<int>, value array<float>"

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 3):
                x = vectors(part.column(3).to_pylist())
                cut = np.searchsorted(x.doc, np.arange(part.num_rows + 1)).astype(np.int32)
                columns = [
                    part.column(0), part.column(1), part.column(2), pa.array(list(x.dense), pa.list_(pa.float64())),
                    pa.ListArray.from_arrays(pa.array(cut), pa.array(x.bucket.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(cut), pa.array(x.value.astype(np.float32))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "doc_id", "label", "dense", "bucket", "value"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches)).combine_chunks().sort_by([("h", "ascending"), ("doc_id", "ascending")])
        count = whole.column("bucket").combine_chunks().value_lengths().to_numpy()
        flat = lambda name, kind: whole.column(name).combine_chunks().flatten().to_numpy().astype(kind)
        dense = flat("dense", float).reshape(len(count), len(FIGURES))
        x = Vectors(dense, np.repeat(np.arange(len(count)), count), flat("bucket", np.int64), flat("value", float))
        machine = Machine.new().fit(x, whole.column("label").to_numpy().astype(float), epochs)
        yield pa.RecordBatch.from_arrays([pa.array([machine.packed()])], names=["model"])

    with Scratch(docs.sparkSession, "quality-sample") as scratch:
        chosen = _chosen(docs, labels, label, rows, sample).select("h", "doc_id", "label", "text")
        chosen = scratch.table(chosen.mapInArrow(features, schema))
        if not chosen.take(1):
            return Machine.new()
        # One task: the sample's bound bounds it.
        model = chosen.coalesce(1).mapInArrow(fit, "model binary").first()
    return Machine.unpacked(bytes(model["model"]))


def score(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """``docs`` (text and any others) with the score of every whole text; a null text is an empty one.

    Rows are scored one by one, so repeated rows agree, and an empty table gives an empty one. An input
    column named as the score is replaced.
    """
    docs = docs.select(*cols(docs, (name,)))
    key, packed = fresh(docs, "_scored"), machine.packed()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Machine.unpacked(packed)
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([texts], names=["text"])
            found = [own.score(vectors(part.column(0).to_pylist())) for part in text_slices(batch)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0))

    out = docs.withColumn(key, F.arrow_udf(run, "double")(quoted("text").cast("string")))
    return out.select(*cols(docs), quoted(key).alias(name))
