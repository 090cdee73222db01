"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns vectors with fast pseudo-rotations (three rounds of random signs and a Hadamard transform)
and files a vector under the signed axes it comes nearest to, one of 2 d for each rotation; some rotations are
joined to one key (``PLAN``). A query probes, in every table, the keys whose axes it comes nearest to in sum. All
it meets there is reranked by the exact cosine of the original vectors, in double precision. What a query does
depends on what it meets, never on the size of the table.

Scale: equal vectors (or power-of-two multiples) are one class with its few smallest ids, so a vector
that fills a third of the table costs one. What is filed and joined by bucket is numbers; a bucket that a
tight cluster fills is cut on both sides. Vectors move once: rows lie in blocks, and a group holds a block, some
queries and the numbers of those of its rows that each query has met, and returns the best few of each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from unmask.operators.skew import ROWS_PER_SALT, salted_join, salted_keys
from unmask.session import Scratch, durable

SEED = 5_005
TABLES = 16
# Rotations joined to a key, and keys that a query probes in a table: the same for any number of vectors.
PLAN = [(1 << 62, 2, 160)]
# Classes a query must meet; the nearest of few are less near, so one that meets fewer is compared with every class.
LEAST_MET = 1_000
# Axes of each rotation that joined keys are made of.
AXES = 48
BLOCK_ROWS = 4_000
# Rows of a block that are scored at once.
SLICE = 1_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Unnormalised Hadamard transform of each row; the width is a power of two."""
    n, width, step = len(x), x.shape[1], 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x


def axis_scores(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Rotated coordinates and their negatives: how near each row is to each signed axis."""
    width = 1 << (x.shape[1] - 1).bit_length()
    signs = np.random.default_rng([seed, table]).integers(0, 2, size=(3, width)) * 2 - 1
    turned = np.zeros((len(x), width))
    turned[:, : x.shape[1]] = x
    for s in signs:
        turned = hadamard(turned * s)
    return np.concatenate([turned, -turned], axis=1)


def usable(vectors: DataFrame, vector: str, dim: int) -> DataFrame:
    """(vec_id, vec): packed doubles, of vectors that are not null or zero and hold finite numbers only.

    Vectors are scaled by a power of two to a largest component in [0.5, 1), which changes no cosine.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None]) + 0.0
            packed = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["vec_id", "vec"])

    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = vectors.filter((F.size(v) == dim) & fine & F.exists(v, lambda x: x != 0))
    return some.mapInArrow(run, "vec_id long, vec binary")


def _matrix(packed: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(packed), dtype=np.float64).reshape(len(packed), -1)


def best_of_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """(query, class_id, score): the ``k`` nearest classes of each query among the rows, without its own."""
    q, mine = _matrix(queries["vec"]), queries["query"].to_numpy()
    length = np.sqrt((q * q).sum(1))[:, None]
    at, to, value = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    for start in range(0, len(rows), SLICE):
        part = rows.iloc[start : start + SLICE]
        x, theirs = _matrix(part["vec"]), part["class_id"].to_numpy()
        score = (q @ x.T) / (length * np.sqrt((x * x).sum(1)))
        score[mine[:, None] == theirs] = -np.inf
        n = min(k, score.shape[1])
        least = -np.partition(-score, n - 1, axis=1)[:, n - 1]
        i, j = np.nonzero((score >= least[:, None]) & (score > -np.inf))
        at, to, value = np.r_[at, i], np.r_[to, theirs[j]], np.r_[value, score[i, j]]
        order = np.lexsort((to, -value, at))
        at, to, value = at[order], to[order], value[order]
        keep = np.arange(len(at)) - np.searchsorted(at, np.arange(len(q)))[at] < k
        at, to, value = at[keep], to[keep], value[keep]
    return pd.DataFrame({"query": mine[at], "class_id": to, "score": value})


def keys(x: np.ndarray, table: int, joined: int, probes: int, seed: int) -> np.ndarray:
    """The ``probes`` keys of each row whose axes it is nearest to in sum over the table's rotations, best first."""
    best = total = None
    for rotation in range(joined):
        score = axis_scores(x, table * joined + rotation, seed)
        width = score.shape[1]
        few = np.argsort(-score, axis=1, kind="stable")[:, : min(probes if joined == 1 or probes == 1 else AXES, width)]
        own = np.take_along_axis(score, few, 1)
        if best is None:
            best, total = few.astype(np.int64), own
            continue
        total = (total[:, :, None] + own[:, None, :]).reshape(len(x), -1)
        best = (best[:, :, None] * width + few[:, None, :]).reshape(len(x), -1)
        order = np.argsort(-total, axis=1, kind="stable")[:, :probes]
        best, total = np.take_along_axis(best, order, 1), np.take_along_axis(total, order, 1)
    return best[:, :probes]


def _filed(df: DataFrame, key: str, tables: int, joined: int, probes: int, seed: int) -> DataFrame:
    """(table, bucket, key): every vector's number under its ``probes`` nearest keys of each table."""
    step = SLICE if joined < 3 else SLICE // 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                x = _matrix(part.column(1).to_pylist())
                for t in range(tables):
                    found = keys(x, t, joined, probes, seed)
                    which = pa.array(np.repeat(np.arange(len(x)), found.shape[1]))
                    columns = [pa.array(np.full(found.size, t, dtype=np.int32)), pa.array(found.ravel()), part.column(0).take(which)]
                    yield pa.RecordBatch.from_arrays(columns, names=["table", "bucket", key])

    return df.select(key, "vec").mapInArrow(run, f"table int, bucket long, {key} long")


def rerank(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """(query, class_id, score, met): the ``k`` nearest of the rows that each query has met (``ids``), without its own.

    ``met`` is their number, in the first row of each query; the others have 0.
    """
    rows = rows.sort_values("class_id")
    x, theirs = _matrix(rows["vec"]), rows["class_id"].to_numpy()
    norm = np.sqrt((x * x).sum(1))
    out: list[tuple[int, int, float, int]] = []
    for query, vec, ids in zip(queries["query"].tolist(), queries["vec"], queries["ids"], strict=True):
        q, ids = np.frombuffer(vec), np.asarray(ids, dtype=np.int64)
        at = np.searchsorted(theirs, ids[ids != query])
        score = (x[at] @ q) / (np.sqrt((q * q).sum()) * norm[at])
        order = np.lexsort((theirs[at], -score))[:k]
        out += zip([query] * len(order), theirs[at][order].tolist(), score[order].tolist(), [len(at)] + [0] * (len(order) - 1))
    return pd.DataFrame(out, columns=["query", "class_id", "score", "met"])


def dealt(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the vectors: it is dealt by the key, never copied whole through the driver.

    Files are small beside what they hold, so the size of a file must not decide.
    """
    return side.hint("merge")


def met(queries: DataFrame, classes: DataFrame, plan: tuple[int, int, int], scratch: Scratch, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """(query, class_id): all classes in the buckets that a query probes, each once. ``plan``: tables, joined, probes."""
    tables, joined, probes = plan
    place = F.xxhash64("table", "bucket").alias("place")
    filed = scratch.table(_filed(classes, "class_id", tables, joined, 1, SEED).select(place, "class_id"))
    probing = _filed(queries, "query", tables, joined, probes, SEED).select(place, "query")
    crowded = salted_keys(filed.groupBy("place").agg(F.count("*").alias("n")), "place", "n", rows_per_salt)
    return salted_join(probing, dealt(filed), "place", crowded, "class_id", rows_per_salt=rows_per_salt).select("query", "class_id").distinct()


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vector: str = "embedding",
    tables: int = TABLES,
    plan: list[tuple[int, int, int]] = PLAN,
    block_rows: int = BLOCK_ROWS,
    rows_per_salt: int = ROWS_PER_SALT,
    least_met: int = LEAST_MET,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's ``k`` nearest other rows found, by cosine.

    ``vectors`` has vec_id and the vector; ``is_query`` says which rows are queries; other columns are
    not read. Vectors that are null, zero, or hold null or non-finite components take no part, nor do
    those of another dimension than most have. Equal vectors are all candidates, ties go to the
    smaller vec_id, and a query with k candidates or fewer gets them all: one that meets fewer than
    ``least_met`` (or k) classes in its buckets is compared with every class. Rows repeating a vec_id count as one.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), F.col(vector).cast("array<double>").alias(vector)).filter(
        "vec_id is not null"
    )
    sizes = rows.filter(F.size(vector) > 0).groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n"))
    dim = sizes.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    dim = dim[0]["d"] if dim else 1
    with Scratch(spark, "nearest") as scratch:
        own = scratch.table(usable(rows, vector, dim).distinct())
        # The smallest ids of each class; the limit applies before the shuffle, so a hot class is cut early.
        nth = F.row_number().over(W.partitionBy("vec").orderBy("vec_id"))
        few = own.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
        members = F.transform(F.sort_array(F.collect_list(F.struct("nth", "vec_id"))), lambda m: m["vec_id"])
        classes = few.groupBy("vec").agg(F.min("vec_id").alias("class_id"), members.alias("members"))
        classes = scratch.table(classes)
        asked = own.filter(is_query).join(dealt(classes.select("vec", "class_id")), "vec")
        asked = scratch.table(asked.select(F.col("vec_id").alias("query_id"), F.col("class_id").alias("query")))
        mine = asked.select("query").distinct().join(dealt(classes), F.col("query") == F.col("class_id"))
        queries = scratch.table(mine.select("query", "vec"))

        n_classes = classes.count()
        _, joined, probes = plan[0]
        blocks, parts = n_classes // block_rows + 1, queries.count() // block_rows + 1
        block = F.pmod(F.xxhash64("class_id"), F.lit(blocks)).cast("int").alias("block")
        part = F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int").alias("part")
        pairs = met(queries, classes, (tables, joined, probes), scratch, rows_per_salt)
        # A list holds rows of one block, a group the lists of some queries.
        lists = pairs.groupBy("query", block).agg(F.collect_list("class_id").alias("ids"))
        left = lists.join(dealt(queries), "query").select("query", "vec", "ids", "block", part)
        right = classes.select("class_id", "vec", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

        def nearest(few: pd.DataFrame, many: pd.DataFrame) -> pd.DataFrame:
            if few.empty or many.empty:
                return pd.DataFrame({"query": [], "class_id": [], "score": [], "met": []})
            return rerank(few, many, k) if "ids" in few else best_of_block(few, many, k).assign(met=0)

        found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
        found = scratch.table(found.applyInPandas(nearest, "query long, class_id long, score double, met long"))

        enough = min(max(k, least_met), n_classes - 1)
        full = found.groupBy("query").agg(F.sum("met").alias("n")).filter(F.col("n") >= enough)
        short = scratch.table(queries.join(dealt(full), "query", "left_anti")) if enough > 0 else queries.limit(0)
        if short.take(1):
            left = short.select("query", "vec", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
            exact = left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
            exact = exact.applyInPandas(nearest, "query long, class_id long, score double, met long")
            found = found.join(dealt(short.select("query")), "query", "left_anti").select("query", "class_id", "score").unionByName(exact.drop("met"))

        best = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "class_id"))
        found = found.withColumn("nth", best).filter(F.col("nth") <= k).select("query", "class_id", "score")
        itself = queries.mapInArrow(_own_score, "query long, class_id long, score double")
        entries = found.unionByName(itself).join(dealt(classes.select("class_id", "members")), "class_id")
        entries = entries.select("query", F.explode("members").alias("vec_id"), "score")
        best = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
        entries = entries.withColumn("nth", best).filter(F.col("nth") <= k + 1)
        lists = F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("entries")
        lists = entries.groupBy("query").agg(lists)
        out = asked.join(dealt(lists), "query").select(
            "query_id", F.slice(F.filter("entries", lambda e: e["vec_id"] != F.col("query_id")), 1, k).alias("entries")
        )
        out = out.select("query_id", F.posexplode("entries").alias("at", "e"))
        return durable(out.select("query_id", (F.col("at") + 1).alias("rank"), "e.vec_id", "e.score"), "nearest")


def _own_score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cosine of each query with the equal vectors of its own class, by the same formula."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column(1).to_pylist())
        norm = np.sqrt((x * x).sum(1))
        score = (x * x).sum(1) / (norm * norm)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(0), pa.array(score)], names=["query", "class_id", "score"])
