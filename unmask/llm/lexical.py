"""Ranked lexical search, hybrid of term at a time and document at a time.

Documents are indexed in slices of bounded text: a slice holds, for every term of the questions, its
rows and their counts, and the length of every document. A question is then answered in two steps.

* Term at a time: the postings of its short lists (terms in at most one of ``short`` documents) are
  joined and summed to accumulators, one for each document that they touch. The k-th best accumulator of
  all is a score that the answer reaches at least.
* Document at a time: within a slice the accumulators are one more sorted list, bounded by their largest,
  beside the long lists, bounded by largest count and shortest document. Lists whose bounds together stay
  below the least score are only probed for documents that the other lists give; the least score rises
  with what is found. A slice whose bounds in sum cannot reach it is not visited at all.

Scores are whole numbers, so nothing is rounded; ties go to the smaller doc_id.

Scale: the index is made where the text is read, and no list is ever gathered over slices. What a group
holds is bounded by a slice's text and ``ITEMS`` questions. A bitmap of fixed size keeps other terms out of
the index, a join decides. Accumulators are sums with map-side combine, cut to k an item before the ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from unmask.llm.common import fresh
from unmask.llm.split import SLICE_CHARS, Bitmap, ascii_lower, byte_table, split_words, text_slices
from unmask.session import Scratch, durable

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_OTHER = bytes(b for b in range(128) if not chr(b).isalnum())
_TABLE = byte_table(_OTHER)
K = 10
SHORT = 100
# Questions that one group answers, documents that are scored at once.
ITEMS = 64
WINDOW = 512
_INDEX = "slice long, term string, rows array<int>, tfs array<int>, ns array<long>, max_tf int, min_n long, doc_ids array<long>"


def index(docs: DataFrame, terms: Bitmap | None = None, chars: int = SLICE_CHARS) -> DataFrame:
    """Slices of the inverted index of ``docs`` (doc_id, text).

    A row with a term holds its rows in the slice (ascending), counts, and those documents' lengths; the
    row without one holds doc_id and length of all the slice's documents. ``terms`` leaves out others.
    """

    def lists(part: pa.RecordBatch, number: int) -> Iterator[dict]:
        words = split_words(part.column(1).to_pylist(), _TABLE)
        n = np.bincount(words.doc, minlength=part.num_rows)
        at = np.arange(len(words.names)) if terms is None else np.flatnonzero(terms.has(words.hashes()))
        known = np.zeros(len(words.names), dtype=bool)
        known[at] = True
        some = known[words.code]
        found, tf = np.unique(words.code[some] * part.num_rows + words.doc[some], return_counts=True)
        code, row = np.divmod(found, part.num_rows)
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        yield {"number": number, "names": words.names.take(pa.array(code[starts])), "starts": starts, "rows": row, "tfs": tf, "ns": n[row]}
        yield {"number": number, "doc_ids": part.column(0), "n": n}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for batch in batches:
            for part in text_slices(batch, 1, chars):
                number = (part.column(2)[0].as_py() << 32) + made
                made += 1
                for x in lists(part, number):
                    yield _terms(x) if "names" in x else _documents(x)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.spark_partition_id().cast("long"))
    return rows.mapInArrow(run, _INDEX)


_FIELDS = pa.schema([
    ("slice", pa.int64()), ("term", pa.string()), ("rows", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32())),
    ("ns", pa.list_(pa.int64())), ("max_tf", pa.int32()), ("min_n", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
])


def _terms(x: dict) -> pa.RecordBatch:
    starts, count = x["starts"], len(x["starts"])
    offsets = pa.array(np.append(starts, len(x["rows"])).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x[name].astype(kind))) for name, kind in (("rows", np.int32), ("tfs", np.int32), ("ns", np.int64))]
    most, least = (f.reduceat(x[name], starts) if count else np.zeros(0, dtype=np.int64) for f, name in ((np.maximum, "tfs"), (np.minimum, "ns")))
    columns = [
        pa.array(np.full(count, x["number"])), x["names"].cast(pa.string()), *lists,
        pa.array(most.astype(np.int32)), pa.array(least.astype(np.int64)), pa.nulls(count, pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_FIELDS)


def _documents(x: dict) -> pa.RecordBatch:
    row = {name: None for name in _FIELDS.names}
    row |= {"slice": x["number"], "ns": x["n"].tolist(), "doc_ids": x["doc_ids"].to_pylist()}
    return pa.RecordBatch.from_pylist([row], schema=_FIELDS)


def length_part(n: Column, n_docs: int, n_terms: int) -> Column:
    """m of a document with ``n`` terms."""
    return F.lit(25).cast("long") + _div(F.lit(75).cast("long") * n * F.lit(n_docs).cast("long"), F.lit(n_terms).cast("long"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def count_part(tf: Column, m: Column) -> Column:
    tf = tf.cast("long")
    return _div(F.lit(1_000_000_000).cast("long") * tf, F.lit(1000).cast("long") * tf + F.lit(8).cast("long") * m)


def best_rows(lists: list[tuple[np.ndarray, np.ndarray, int, int]], k: int, least: int, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the ``k`` best rows with ``least`` or more, document at a time.

    A list is (rows ascending, parts, factor, bound): a row in it scores factor * part, at most bound.
    ``ties`` orders rows of equal scores.
    """
    lists = sorted((x for x in lists if len(x[0])), key=lambda x: x[3])
    reach = np.cumsum([0] + [x[3] for x in lists])
    top, score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at, leads = 0, -1
    while True:
        # Lists below this one cannot lift a row to the least score by themselves.
        now = int(np.searchsorted(reach[1:], least))
        if now != leads:
            leads = now
            if leads == len(lists):
                break
            rest = [x[0][np.searchsorted(x[0], at) :] for x in lists[leads:]]
            given = rest[0] if len(rest) == 1 else np.unique(np.concatenate(rest))
            place = 0
        rows = given[place : place + WINDOW].astype(np.int64)
        if not len(rows):
            break
        place, at = place + WINDOW, int(rows[-1]) + 1
        total = np.zeros(len(rows), dtype=np.int64)
        for j in range(len(lists) - 1, -1, -1):
            if j < leads:
                open_ = total + reach[j + 1] >= least
                rows, total = rows[open_], total[open_]
                if not len(rows):
                    break
            mine, part, factor, _ = lists[j]
            spot = np.searchsorted(mine, rows)
            spot[spot == len(mine)] = 0
            total += np.where(mine[spot] == rows, part[spot] * factor, 0)
        good = total >= least
        if good.any():
            top, score = np.concatenate([top, rows[good]]), np.concatenate([score, total[good]])
            order = np.lexsort((ties[top], -score))[:k]
            top, score = top[order], score[order]
            if len(score) == k:
                least = max(least, int(score[-1]))
    return top, score


def _visit(n_docs: int, n_terms: int, k: int):
    """Answers of one slice to some questions: their accumulators on the left, the slice's lists on the right."""

    def run(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = {"item": [], "doc_id": [], "slice": [], "row": [], "score": []}
        if not asked.empty and not held.empty:
            whole = held["term"].isna().to_numpy()
            documents = held[whole].iloc[0]
            n = np.asarray(documents["ns"], dtype=np.int64)
            m = 25 + 75 * n * n_docs // max(n_terms, 1)
            ids = [None if x is None or x != x else int(x) for x in documents["doc_ids"]]
            # Rows in the order of doc_id, rows without one last.
            ties = np.empty(len(ids), dtype=np.int64)
            ties[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, i))] = np.arange(len(ids))
            lists = {}
            for term, rows, tfs in held.loc[~whole, ["term", "rows", "tfs"]].itertuples(index=False):
                rows, tf = np.asarray(rows, dtype=np.int64), np.asarray(tfs, dtype=np.int64)
                part = 1_000_000_000 * tf // (1000 * tf + 8 * m[rows])
                lists[term] = rows, part, int(part.max())
            for q in asked.itertuples(index=False):
                own = [(lists[t["term"]][0], lists[t["term"]][1], t["weight"], lists[t["term"]][2] * t["weight"]) for t in (q.terms if q.terms is not None else ()) if t["term"] in lists]
                if q.rows is not None and len(q.rows):
                    sums = np.asarray(q.sums, dtype=np.int64)
                    own.append((np.asarray(q.rows, dtype=np.int64), sums, 1, int(sums.max())))
                top, score = best_rows(own, k, q.least, ties)
                out["item"] += [q.item] * len(top)
                out["doc_id"] += [ids[r] for r in top.tolist()]
                out["slice"] += [documents["slice"]] * len(top)
                out["row"] += top.tolist()
                out["score"] += score.tolist()
        return pd.DataFrame(out).astype({"doc_id": "Int64"})

    return run


def search(docs: DataFrame, items: DataFrame, k: int = K, short: int = SHORT, chars: int = SLICE_CHARS, items_per_group: int = ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best rows of ``docs`` (doc_id, text) for each row of ``items``.

    ``items`` has item_id and text; other columns are not read. A null text holds no term: as a document
    it is not counted, as an item it has no answer. Every row is a document or an item of its own, also
    where ids repeat or are null; documents without an id rank after others of equal score. Empty tables
    give an empty answer.
    """
    spark = docs.sparkSession
    with Scratch(spark, "lexical") as scratch:
        uid = fresh(items, "item")
        asked = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id"), F.col("text").cast("string").alias(f"{uid}_text"))
        asked = scratch.table(asked)
        found = F.regexp_extract_all(ascii_lower(F.col(f"{uid}_text")), F.lit(TERM), F.lit(0))
        terms = asked.select("item", F.explode(found).alias("term")).groupBy("item", "term").agg(F.count("*").alias("times"))
        terms = scratch.table(terms)
        names = terms.select("term").distinct()

        slices = index(docs, Bitmap.of(names.select(F.xxhash64("term").alias("h"))), chars)
        # The row of a slice's documents has no term and stays; other terms that the bitmap let through go.
        names = names.union(spark.createDataFrame([(None,)], "term string")).withColumnRenamed("term", "name")
        slices = scratch.table(slices.join(names, F.col("term").eqNullSafe(F.col("name")), "left_semi"))
        whole, lists = slices.filter("term is null"), slices.filter("term is not null")
        counted = whole.select(
            F.size(F.filter("ns", lambda n: n > 0)).alias("docs"), F.aggregate("ns", F.lit(0).cast("long"), lambda a, n: a + n).alias("terms")
        )
        n_docs, n_terms = counted.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()

        df = lists.groupBy("term").agg(F.sum(F.size("rows")).alias("df"))
        weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0))))
        weighed = terms.join(df, "term").select(
            "item", "term", (F.col("times") * weight.cast("long")).alias("weight"), (F.lit(short) * F.col("df") > n_docs).alias("long")
        )
        weighed = scratch.table(weighed)
        is_long = F.col("long")

        posting = F.arrays_zip("rows", "tfs", "ns")
        touched = lists.join(weighed.filter(~is_long), "term").select("item", "slice", "weight", F.explode(posting).alias("p"))
        part = F.col("weight") * count_part(F.col("p.tfs"), length_part(F.col("p.ns"), n_docs, max(n_terms, 1)))
        sums = touched.groupBy("item", "slice", F.col("p.rows").alias("row")).agg(F.sum(part).alias("total"))
        entries = F.sort_array(F.collect_list(F.struct("row", "total")))
        sums = sums.groupBy("item", "slice").agg(entries.alias("entries"))
        sums = scratch.table(sums.select("item", "slice", F.col("entries.row").alias("rows"), F.col("entries.total").alias("sums")))

        best = sums.select("item", F.explode(F.slice(F.sort_array("sums", asc=False), 1, k)).alias("total"))
        nth = F.row_number().over(W.partitionBy("item").orderBy(F.desc("total")))
        best = best.withColumn("nth", nth).filter(F.col("nth") <= k)
        least = best.filter(F.col("nth") == k).select("item", "total")

        bound = F.col("weight") * count_part(F.col("max_tf"), length_part(F.col("min_n"), n_docs, max(n_terms, 1)))
        reached = lists.select("slice", "term", "max_tf", "min_n").join(weighed.filter(is_long), "term")
        reached = reached.groupBy("slice", "item").agg(F.sum(bound).alias("bound"))
        opened = reached.join(sums, ["slice", "item"], "full").join(least, "item", "left")
        opened = opened.withColumn("least", F.greatest(F.coalesce("total", F.lit(1)), F.lit(1)).cast("long"))
        can = F.coalesce("bound", F.lit(0)) + F.coalesce(F.array_max("sums"), F.lit(0))
        opened = opened.filter(can >= F.col("least"))
        own_terms = weighed.filter(is_long).groupBy("item").agg(F.collect_list(F.struct("term", "weight")).alias("terms"))
        parts = F.lit(terms.select("item").distinct().count() // items_per_group + 1)
        opened = opened.join(own_terms, "item", "left").withColumn("part", F.pmod(F.xxhash64("item"), parts).cast("int"))
        opened = scratch.table(opened.select("slice", "part", "item", "least", "terms", "rows", "sums"))

        long_names = weighed.filter(is_long).select("term").distinct().withColumnRenamed("term", "name")
        visited = opened.select(F.col("slice").alias("slice"), F.col("part").alias("part")).distinct()
        needed = whole.select("slice", "term", "rows", "tfs", "ns", "doc_ids")
        needed = needed.union(
            lists.join(long_names, F.col("term") == F.col("name"), "left_semi").select(
                "slice", "term", "rows", "tfs", F.lit(None).cast("array<long>"), F.lit(None).cast("array<long>")
            )
        )
        held = needed.join(visited, "slice")
        answers = opened.groupBy("slice", "part").cogroup(held.groupBy("slice", "part"))
        answers = answers.applyInPandas(_visit(n_docs, n_terms, k), "item long, doc_id long, slice long, row long, score long")
        order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "slice", "row")
        answers = answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        answers = answers.join(asked.select("item", "item_id"), "item")
        return durable(answers.select("item_id", F.col("rank").cast("int"), "doc_id", "score"), "ranked")
