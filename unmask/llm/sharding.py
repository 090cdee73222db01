"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

How many rows of every input partition go to every shard is drawn first: partition after partition
takes a multivariate hypergeometric share of the places that are left. Rows are permuted within their
partition and dealt out by that matrix, exchanged, and permuted again within their shard. Every
arrangement of the rows is then equally likely, and shard sizes differ by one at most.

Scale: the driver draws only for about sqrt(P) groups of the P input partitions, and a task draws for
the partitions of a group. Places within a shard are numbered by pieces of the hash range, so no task
holds a shard. Input partitions are pieces of a written table, so a lost executor changes nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from unmask.llm.common import cols, fresh, prefix_sums, quoted
from unmask.session import Scratch, durable

SEED = 20_011
# Rows of a shard that are numbered in one task.
PIECE_ROWS = 20_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among ``n`` drawn without replacement; inverts the distribution around its mode.

    Probabilities come from ratios of neighbours, so any counts do. Twelve standard deviations on
    either side hold all but 1e-30 of the mass.
    """
    low, high = max(0, n - bad), min(good, n)
    if low == high:
        return low
    total = good + bad
    mode = (n + 1) * (good + 1) // (total + 2)
    spread = math.sqrt(n * (good / total) * (bad / total) * max(total - n, 1) / max(total - 1, 1))
    reach = int(12 * spread) + 40
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(weight - weight.max()))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], side="right").clip(0, high - low))


def draw(rng: np.random.Generator, places: list[int], n: int) -> list[int]:
    """How many of ``n`` rows each shard takes, given the places left in each."""
    out, left = [], sum(places)
    for p in places:
        take = hypergeometric(rng, p, left - p, n)
        out.append(take)
        left, n = left - p, n - take
    return out


def shuffle_into_shards(
    df: DataFrame, n_shards: int, seed: int = SEED, shard: str = "shard", slot: str = "slot"
) -> DataFrame:
    """Every row once, with its ``shard`` (from 0) and its ``slot`` there (from 0, without gaps).

    Rows are not compared, so nulls, equal rows and any column do. Input columns named as the two
    outputs are replaced. An empty table gives an empty table. The same table read in the same
    splits gives the same shards again.
    """
    spark = df.sparkSession
    df = df.select(*cols(df, (shard, slot)))
    uid = fresh(df, "_uid")
    rows = durable(df.withColumn(uid, F.monotonically_increasing_id()), "shard-rows")
    with Scratch(spark, "shards") as scratch:
        # Upper bits of the id: the input partition that wrote the row.
        ids = rows.select(quoted(uid).alias("uid"), F.shiftright(quoted(uid), 33).alias("part"))
        counts = scratch.table(ids.groupBy("part").agg(F.count("*").alias("n")))
        top = counts.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0] + 1
        width = math.isqrt(top - 1) + 1
        groups = counts.groupBy(F.floor(F.col("part") / width).alias("g")).agg(F.sum("n").alias("n"))
        groups = sorted((r["g"], r["n"]) for r in groups.collect())
        total = sum(n for _, n in groups)
        places = [total // n_shards + (k < total % n_shards) for k in range(n_shards)]
        shares: dict[int, list[int]] = {}
        for g, n in groups:
            shares[g] = draw(np.random.default_rng([seed, 0, g]), places, n)
            places = [p - s for p, s in zip(places, shares[g], strict=True)]

        def matrix_rows(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            rng, left, out = np.random.default_rng([seed, 1, key[0]]), shares[key[0]], []
            for p, n in part.sort_values("part")[["part", "n"]].itertuples(index=False):
                row = draw(rng, left, int(n))
                left = [x - y for x, y in zip(left, row, strict=True)]
                out.append((p, np.cumsum(row).tolist()))
            return pd.DataFrame(out, columns=["part", "bounds"])

        matrix = counts.groupBy(F.floor(F.col("part") / width).alias("g")).applyInPandas(
            matrix_rows, "part long, bounds array<long>"
        )
        local = W.partitionBy("part").orderBy(F.xxhash64("uid", F.lit(seed)), "uid")
        dealt = (
            ids.withColumn("at", F.row_number().over(local) - 1)
            .join(matrix, "part")
            .select("uid", F.size(F.filter("bounds", lambda b: b <= F.col("at"))).alias("shard"))
        )
        bits = max(0, math.ceil(math.log2(max(1, total / n_shards / PIECE_ROWS))))
        mixed = F.xxhash64("uid", F.lit(seed + 1))
        piece = F.shiftrightunsigned(mixed, 64 - bits) if bits else F.lit(0).cast("long")
        dealt = dealt.select("uid", "shard", mixed.alias("h"), piece.alias("piece"), F.lit(1).cast("long").alias("one"))
        placed = durable(
            prefix_sums(scratch.table(dealt), ["shard"], "piece", ["h", "uid"], "one", "slot").select(
                "uid", F.col("shard").cast("int").alias("shard"), "slot"
            ),
            "shard-places",
        )
    out = rows.alias("r").join(placed.alias("p"), quoted(uid) == F.col("p.uid"))
    kept = [F.col("r.`" + c.replace("`", "``") + "`") for c in df.columns]
    return out.select(*kept, F.col("p.shard").alias(shard), F.col("p.slot").alias(slot))
