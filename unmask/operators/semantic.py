"""Word vectors from neighbour counts, weighted document vectors and cosine search."""

from __future__ import annotations

import itertools
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unmask.functions import text as tx
from unmask.operators import weights
from unmask.operators.blocks import best_in_blocks, matrix
from unmask.operators.order import with_position
from unmask.session import durable

# Vector size, window, rarest word kept.
VECTOR_SIZE = 100
WINDOW = 10
MIN_COUNT = 5
SCORE_DIGITS = 6
# Lengths of the pieces that spell a word, and the places they are hashed to.
SUBWORDS = (3, 5)
SUBWORD_PLACES = 1 << 15
# Words up to which the vocabulary is copied to the tasks, about 15 bytes each; more are joined.
BROADCAST_WORDS = 4_000_000
# Words whose pairs are counted at once, pairs of a part, and pairs that wait for being merged.
CHUNK_WORDS = 1_500_000
PART_PAIRS = 20_000_000
MERGED_PAIRS = 8_000_000
# Ends a document in a packed list of word numbers.
END = 0xFFFFFFFF
# Word vectors of a block (800 bytes each), words of documents in a group, and rows that are scaled at once.
BLOCK_TERMS = 100_000
GROUP_ROWS = 4_000_000
SLICE_ROWS = 50_000


def word_vectors(
    df: DataFrame, key: str, text: str, size: int = VECTOR_SIZE, window: int = WINDOW, min_count: int = MIN_COUNT,
    broadcast_words: int = BROADCAST_WORDS, chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """(term, n, vector): positive pointwise mutual information of each word with its neighbours.

    Words seen fewer than ``min_count`` times are left out first; neighbours are the next and the
    previous ``window`` words of the same document. The information with each neighbour is added, with
    a sign, at one of ``size`` places that a digest of the neighbour names, so vectors have one size
    whatever the vocabulary. Only counts and sums: any number of tasks gives the same vectors.

    Pairs are counted where the words are, some million words at a time, and move once, as packed counts
    dealt by their first word; all pairs of a word meet in one task, which adds up its vector.
    """
    spark = df.sparkSession
    present = df.filter(F.col(text).isNotNull())
    words = present.select(F.explode(tx.ascii_words(F.col(text))).alias("term"))
    digest = F.conv(F.substring(F.md5("term"), 1, 8), 16, 10).cast("bigint")
    sign = F.when(F.floor(digest / size) % 2 == 0, 1.0).otherwise(-1.0)
    frequent = words.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)
    frequent = durable(frequent.select("term", "n", (digest % size).alias("place"), sign.alias("sign")), "frequent-words")
    n_words = frequent.count()
    # Words are numbers from here on, the most frequent first.
    if n_words <= broadcast_words:
        known = frequent.toArrow().sort_by([("n", "descending"), ("term", "ascending")]).combine_chunks()
        vocabulary = spark.sparkContext.broadcast(known["term"].combine_chunks())
        listed = present.select(tx.ascii_words(F.col(text)).alias("words")).mapInArrow(_numbered(vocabulary), "ids binary")
        figures = {c: known[c].to_numpy() for c in ("place", "sign")}
    else:
        frequent = with_position(frequent.orderBy(F.desc("n"), "term"), "tid").withColumn("tid", F.col("tid") - 1)
        frequent = durable(frequent, "numbered-words")
        numbered = present.select(F.monotonically_increasing_id().alias("doc"), text)
        kept = numbered.select("doc", F.posexplode(tx.ascii_words(F.col(text))).alias("pos", "term")).join(frequent.select("term", "tid"), "term")
        # A document's own words, no more than its text holds.
        texts = kept.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("pos", "tid"))).alias("w"))
        listed = texts.select(F.col("w.tid").cast("array<long>").alias("words")).mapInArrow(_packed_lists, "ids binary")
        known = frequent.select("tid", "place", "sign").toArrow().sort_by("tid")
        figures = {c: known[c].to_numpy() for c in ("place", "sign")}
    texts = durable(listed, "word-numbers")
    # How many neighbours a word has follows from its place in the text: no pair is needed for it.
    margins = texts.mapInArrow(_neighbours(window, n_words), "tid long, m long").groupBy("tid").agg(F.sum("m").alias("m")).toArrow()
    figures["m"] = np.zeros(n_words, dtype=np.int64)
    figures["m"][margins["tid"].to_numpy()] = margins["m"].to_numpy()
    total = int(figures["m"].sum())
    shared = spark.sparkContext.broadcast(figures)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(n_words, max(4 * tasks, total // PART_PAIRS)))
    counted = texts.mapInArrow(_pair_counts(window, n_words, parts, chunk_words), "part int, keys binary, counts binary")
    met = counted.repartition(max(tasks, parts // 4), "part").sortWithinPartitions("part")
    vectors = met.mapInArrow(_summed(shared, n_words, parts, size, max(total, 1)), "tid long, vector array<double>")
    if n_words <= broadcast_words:
        numbers = spark.sparkContext.broadcast((known["term"].combine_chunks(), known["n"].to_numpy()))
        return vectors.mapInArrow(_named(numbers), "term string, n long, vector array<double>")
    return vectors.join(frequent.select("tid", "term", "n"), "tid").select("term", "n", "vector")


def _packed(lists: pa.Array, numbers: pa.Array) -> pa.RecordBatch:
    """One row: numbers of the words of some documents one after another, each document ended by ``END``; nulls are left out."""
    ids = pc.fill_null(numbers.cast(pa.int64()), -1).to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    ids = np.insert(ids, offsets[1:] - offsets[0], END)
    return pa.RecordBatch.from_arrays([pa.array([ids[ids >= 0].astype("<u4").tobytes()], pa.binary())], names=["ids"])


def _numbered(vocabulary: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _packed(batch.column(0), pc.index_in(batch.column(0).flatten(), value_set=vocabulary.value))

    return run


def _packed_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _packed(batch.column(0), batch.column(0).flatten())


def _pairs(ids: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each distance up to ``window``, the numbers that stand so far apart in one document."""
    ends = ids == END
    doc, ids = (np.cumsum(ends) - ends)[~ends], ids[~ends].astype(np.int64)
    for k in range(1, window + 1):
        same = doc[:-k] == doc[k:]
        yield ids[:-k][same], ids[k:][same]


def _neighbours(window: int, n_words: int) -> Callable:
    """(tid, m): how many neighbours a word has, summed over a task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(n_words, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                for a, b in _pairs(np.frombuffer(packed.as_buffer(), dtype="<u4"), window):
                    sums += np.bincount(a, minlength=n_words) + np.bincount(b, minlength=n_words)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["tid", "m"])

    return run


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes before all second ones, compressed."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unsqueezed(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd"), dtype=np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


def _unique(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts summed."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _pair_counts(window: int, n_words: int, parts: int, chunk_words: int) -> Callable:
    """(part, keys, counts): pairs of both directions, dealt by the first word; a part's keys are sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def count(held: list[np.ndarray]) -> pa.RecordBatch:
            codes = [np.minimum(a, b) * n_words + np.maximum(a, b) for a, b in _pairs(np.concatenate(held), window)]
            codes, n = np.unique(np.concatenate(codes), return_counts=True)
            a, b = np.divmod(codes, n_words)
            same = a == b
            n[same] *= 2
            a, b, n = np.r_[a, b[~same]], np.r_[b, a[~same]], np.r_[n, n[~same]]
            part, key = a % parts, a // parts * n_words + b
            order = np.lexsort((key, part))
            part, key, n = part[order], key[order], n[order]
            which, first = np.unique(part, return_index=True)
            cuts = [*first.tolist(), len(part)]
            keys = [struct.pack("<q", y - x) + _squeezed(np.diff(key[x:y], prepend=0)) for x, y in itertools.pairwise(cuts)]
            counts = [_squeezed(n[x:y]) for x, y in itertools.pairwise(cuts)]
            columns = [pa.array(which, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "keys", "counts"])

        held, size = [], 0
        for batch in batches:
            for packed in batch.column(0):
                ids = np.frombuffer(packed.as_py(), dtype="<u4")
                # Whole documents, as many as fill a chunk.
                ends = np.flatnonzero(ids == END) + 1
                start = 0
                while start < len(ids):
                    at = min(np.searchsorted(ends, start + chunk_words - size), len(ends) - 1)
                    held.append(ids[start : ends[at]])
                    size += int(ends[at]) - start
                    start = int(ends[at])
                    if size >= chunk_words:
                        yield count(held)
                        held, size = [], 0
        if held:
            yield count(held)

    return run


def _summed(shared: Broadcast, n_words: int, parts: int, size: int, total: int) -> Callable:
    """(tid, vector) of the words of each part; the rows of a part follow one another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign, m = (shared.value[c] for c in ("place", "sign", "m"))

        def vectors(part: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            local, b = np.divmod(keys, n_words)
            a = local * parts + part
            pmi = np.log(n.astype(np.float64) * float(total) / (m[a].astype(np.float64) * m[b]))
            words, at = np.unique(a, return_inverse=True)
            x = np.bincount(at * size + place[b], weights=sign[b] * np.maximum(pmi, 0.0), minlength=len(words) * size)
            offsets = pa.array(np.arange(len(words) + 1, dtype=np.int32) * size)
            return pa.RecordBatch.from_arrays([pa.array(words), pa.ListArray.from_arrays(offsets, pa.array(x))], names=["tid", "vector"])

        now, keys, n, fresh, waiting = None, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), [], 0
        for batch in batches:
            for part, packed, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and (part != now or waiting > MERGED_PAIRS):
                    keys, n = _unique(np.concatenate([keys, *(k for k, _ in fresh)]), np.concatenate([n, *(c for _, c in fresh)]))
                    fresh, waiting = [], 0
                if now is not None and part != now:
                    yield vectors(now, keys, n)
                    keys, n = keys[:0], n[:0]
                now = part
                many = struct.unpack_from("<q", packed)[0]
                fresh.append((np.cumsum(_unsqueezed(packed[8:], many)), _unsqueezed(counts, many)))
                waiting += many
        if now is not None:
            keys, n = _unique(np.concatenate([keys, *(k for k, _ in fresh)]), np.concatenate([n, *(c for _, c in fresh)]))
            yield vectors(now, keys, n)

    return run


def _named(numbers: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, n = numbers.value
        for batch in batches:
            columns = [terms.take(batch.column(0)), pa.array(n[batch.column(0).to_numpy()]), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "n", "vector"])

    return run


def similar_words(vectors: DataFrame, word: str, n: int = 10, restrict_vocab: int | None = None) -> DataFrame:
    """(term, cosine): the words nearest to one; ``restrict_vocab`` looks among the most frequent only."""
    own = vectors.filter(F.col("term") == word).select("vector").first()
    if restrict_vocab:
        vectors = vectors.orderBy(F.desc("n"), "term").limit(restrict_vocab)
    others = vectors.filter(F.col("term") != word)
    return cosine_top_k(others, "term", "vector", own["vector"] if own else [0.0] * VECTOR_SIZE, n)


def _subwords(term: Column, lengths: tuple[int, int], places: int) -> Column:
    """Places of a word's distinct pieces; its ends are marked, so a beginning differs from a middle."""
    marked = F.concat(F.lit("<"), term, F.lit(">"))

    def pieces(text: Column, n: int) -> Column:
        return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, n))).otherwise(F.array().cast("array<string>"))

    found = F.array_distinct(F.flatten(F.transform(F.array(marked), lambda t: F.concat(*[pieces(t, n) for n in range(lengths[0], lengths[1] + 1)]))))
    return F.transform(found, lambda p: F.conv(F.substring(F.md5(p), 1, 8), 16, 10).cast("bigint") % places)


def subword_vectors(vectors: DataFrame, lengths: tuple[int, int] = SUBWORDS, places: int = SUBWORD_PLACES) -> DataFrame:
    """(piece, vector): what the words that hold a piece of 3 to 5 characters mean on average, by their counts.

    Pieces are hashed to a fixed number of places, so the table has one size whatever the vocabulary.
    """
    pieces = vectors.select("n", "vector", F.explode(_subwords(F.col("term"), lengths, places)).alias("piece"))
    return vector_mean(pieces, ["piece"], "vector", F.col("n").cast("double"))


def spelled_vectors(words: DataFrame, term: str, subwords: DataFrame, lengths: tuple[int, int] = SUBWORDS, places: int = SUBWORD_PLACES) -> DataFrame:
    """(term, vector): vectors of any words, seen or not, as the mean of their known pieces; none without one."""
    pieces = words.select(F.col(term).alias("term")).distinct().select("term", F.explode(_subwords(F.col("term"), lengths, places)).alias("piece"))
    return vector_mean(pieces.join(subwords, "piece"), ["term"], "vector")


def vector_mean(df: DataFrame, group: list[str], vector: str, weight: Column | None = None) -> DataFrame:
    """Mean vector per group, combined on the map side."""
    kind = Summarizer.metrics("mean")
    column = array_to_vector(F.col(vector).cast("array<double>"))
    summary = kind.summary(column) if weight is None else kind.summary(column, weight)
    return df.groupBy(*group).agg(summary.alias("_s")).select(*group, vector_to_array("_s.mean").alias(vector))


def document_vectors(df: DataFrame, key: str, text: str, vectors: DataFrame, block: int = BLOCK_TERMS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(id, vector): mean of BM25 weight times word vector over a document's words.

    Documents without any known word have no vector. Vectors lie in blocks of words; a group holds one block and
    the words of some documents that are in it, and returns one sum for each of these documents.
    """
    counts = weights.term_counts(df, key, tx.ascii_words(F.col(text)))
    # A document's words are where its text is, so its length needs no other table.
    counts = durable(counts.withColumn("length", F.sum("tf").over(Window.partitionBy("id"))), "word-counts")
    blocks = max(1, -(-vectors.count() // block))
    parts = max(1, -(-counts.count() // (blocks * group_rows)))
    at = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block")
    idf, mean = weights.bm25_idf(counts) or (counts.select("term", F.lit(0.0).alias("idf")), 1.0)
    # Words move once, to the vectors and the idf of their block.
    words = counts.filter("id is not null").select("id", "length", "term", "tf", at, F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"))
    known = vectors.select("term", F.col("vector").cast("array<double>").alias("vector")).join(idf, "term")
    copies = known.select("term", "vector", "idf", at).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    kind = df.schema[key].dataType.simpleString()
    groups = words.groupBy("block", "part").cogroup(copies.groupBy("block", "part"))
    sums = groups.applyInArrow(lambda few, many: _block_sums(few, many, mean), f"id {kind}, n double, total array<double>")
    # At most one row for each block of words.
    met = sums.groupBy("id").agg(F.sum("n").alias("n"), F.collect_list("total").alias("totals"))
    added = F.reduce(F.slice("totals", 2, blocks), F.get("totals", F.lit(0)), lambda s, x: F.zip_with(s, x, lambda a, b: a + b))
    return met.select("id", F.transform(added, lambda x: x / F.col("n")).alias("vector"))


def _block_sums(words: pa.Table, vectors: pa.Table, mean: float) -> pa.Table:
    """(id, n, total): for each document, words met and the sum of their weighted vectors."""
    known = vectors["term"].combine_chunks()
    found = pc.index_in(words["term"].combine_chunks(), value_set=known) if len(known) else pa.nulls(len(words), pa.int32())
    words = words.append_column("at", found).filter(pc.is_valid(found)).sort_by([("id", "ascending"), ("at", "ascending")])
    schema = pa.schema([("id", words.schema.field("id").type), ("n", pa.float64()), ("total", pa.list_(pa.float64()))])
    if not len(words):
        return schema.empty_table()
    matrix = vectors["vector"].combine_chunks().flatten().to_numpy().reshape(len(known), -1)
    ids, at = words["id"].combine_chunks(), words["at"].to_numpy()
    many = words["tf"].to_numpy().astype(np.float64)
    idf = vectors["idf"].to_numpy()[at]
    scale = many * weights.bm25_weight(idf, many, words["length"].to_numpy(), mean)
    changed = pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)
    first = np.r_[0, np.flatnonzero(changed) + 1]
    total = np.empty((len(first), matrix.shape[1]))
    # Documents of about so many rows at a time.
    step = max(1, len(first) * SLICE_ROWS // len(at))
    for x in range(0, len(first), step):
        y = min(x + step, len(first))
        rows = slice(first[x], first[y] if y < len(first) else len(at))
        total[x:y] = np.add.reduceat(matrix[at[rows]] * scale[rows, None], first[x:y] - first[x])
    offsets = pa.array(np.arange(len(first) + 1, dtype=np.int32) * matrix.shape[1])
    lists = pa.ListArray.from_arrays(offsets, pa.array(total.ravel()))
    return pa.Table.from_arrays([ids.take(pa.array(first)), pa.array(np.add.reduceat(many, first)), lists], schema=schema)


def query_vectors(queries: DataFrame, key: str, text: str, vectors: DataFrame) -> DataFrame:
    """(key, vector): plain mean of the vectors of a query's known words; repeats count each time.

    Queries without a known word have no vector.
    """
    words = queries.select(F.col(key), F.explode(F.filter(F.split(F.lower(F.col(text)), r"\s+"), lambda w: w != "")).alias("term"))
    return vector_mean(words.join(vectors.select("term", "vector"), "term"), [key], "vector")


def cosine_top_k(df: DataFrame, key: str, vector: str, query: list[float], k: int = 5) -> DataFrame:
    """The k rows nearest to one query vector; each task keeps its own k before they meet."""
    q = F.lit([float(x) for x in query]).cast("array<double>")
    v = F.col(vector).cast("array<double>")

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    norm = F.sqrt(dot(v, v)) * F.lit(float(np.linalg.norm(query)))
    scored = df.select(key, (dot(v, q) / F.nullif(norm, F.lit(0.0))).alias("cosine")).filter("cosine is not null")
    return scored.orderBy(F.desc(F.round("cosine", SCORE_DIGITS)), key).limit(k)


def cosine_top_k_many(
    df: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, query_vector: str, k: int = 5
) -> DataFrame:
    """(query_key, key, cosine, rank): the k nearest rows of every query vector, exactly."""

    def cosines(few: pd.DataFrame, many: pd.DataFrame) -> np.ndarray:
        q, x = matrix(few["_v"]), matrix(many["_v"])
        with np.errstate(divide="ignore", invalid="ignore"):
            return (q @ x.T) / np.linalg.norm(q, axis=1)[:, None] / np.linalg.norm(x, axis=1)

    rows = df.select(F.col(key).alias("_id"), F.col(vector).cast("array<double>").alias("_v")).filter("_v is not null")
    asked = queries.select(F.col(query_key).alias("_q"), F.col(query_vector).cast("array<double>").alias("_v")).filter("_v is not null")
    found = best_in_blocks(asked, rows, cosines, k, SCORE_DIGITS)
    return found.select(F.col("_q").alias(query_key), F.col("_id").alias(key), F.col("_s").alias("cosine"), "rank")
