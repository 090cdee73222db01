"""Scoring every query against every row, block by block, keeping each query's best few."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows and queries that a task holds at a time.
BLOCK = 2_000


def best_in_blocks(
    queries: DataFrame,
    rows: DataFrame,
    score: Callable[[pd.DataFrame, pd.DataFrame], np.ndarray],
    k: int,
    digits: int,
    block: int = BLOCK,
) -> DataFrame:
    """(_q, _id, _s, rank): the ``k`` rows of highest score for each query.

    Queries are keyed by ``_q`` and rows by ``_id``; ``score`` gives a matrix from their other columns,
    nan where a pair does not count. Scores are compared after rounding, ties go to the smaller
    ``_id``. Both sides are cut into blocks, and every pair of blocks is one group that returns k rows
    for each of its queries, so neither side has to fit anywhere and no pair leaves its task.
    """
    n_queries, n_rows = queries.count(), rows.count()
    parts, blocks = max(1, math.ceil(n_queries / block)), max(1, math.ceil(n_rows / block))
    types = dict(queries.dtypes)["_q"], dict(rows.dtypes)["_id"]

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def own(key: str, n: int):
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    left = queries.withColumn("_part", own("_q", parts)).withColumn("_block", every(blocks))
    right = rows.withColumn("_block", own("_id", blocks)).withColumn("_part", every(parts))

    def best(few: pd.DataFrame, many: pd.DataFrame) -> pd.DataFrame:
        if few.empty or many.empty:
            return pd.DataFrame({"_q": few["_q"].iloc[:0], "_id": many["_id"].iloc[:0], "_s": np.zeros(0)})
        ids = many["_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        s = score(few, many)[:, order]
        rounded = np.where(np.isnan(s), -np.inf, np.round(s, digits))
        n = min(k, rounded.shape[1])
        top = np.argsort(-rounded, axis=1, kind="stable")[:, :n]
        at = np.repeat(np.arange(len(few)), n)
        value = s[at, top.ravel()]
        keep = ~np.isnan(value)
        return pd.DataFrame({"_q": few["_q"].to_numpy()[at[keep]], "_id": ids[order][top.ravel()[keep]], "_s": value[keep]})

    groups = left.groupBy("_part", "_block").cogroup(right.groupBy("_part", "_block"))
    found = groups.applyInPandas(best, f"_q {types[0]}, _id {types[1]}, _s double")
    rank = F.row_number().over(Window.partitionBy("_q").orderBy(F.desc(F.round("_s", digits)), "_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)
