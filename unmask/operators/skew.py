"""Equi join whose frequent keys are spread over salts on both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SALT = 50_000


def salted_keys(
    counts: DataFrame, key: str, n: str, rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame | None:
    """(key, _salts) for keys with more rows than one salt takes; None if there are none."""
    out = counts.filter(F.col(n) > rows_per_salt).select(
        key, F.ceil(F.col(n) / F.lit(rows_per_salt)).cast("int").alias("_salts")
    )
    return out if out.take(1) else None


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    salted: DataFrame | None,
    right_id: str,
    condition: Column | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Inner join on ``key``; rows of a salted key are cut into parts on both sides.

    Right rows are dealt by ``right_id``, left rows by a hash of the row. Every part of one side meets
    every part of the other once, so a key that fills both sides is a grid of bounded groups.
    """
    if salted is None:
        joined = left.join(right, key)
    else:
        held = left.join(salted, key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        grid = salted.join(held, key).select(
            key, "_salts", F.ceil(F.col("_n") / F.lit(rows_per_salt)).cast("int").alias("_parts")
        )
        salts, parts = F.coalesce("_salts", F.lit(1)), F.coalesce("_parts", F.lit(1))
        columns = left.columns
        left = left.join(grid, key, "left")
        left = left.withColumn("_part", F.pmod(F.xxhash64(*columns), parts).cast("int"))
        left = left.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts", "_parts")
        right = right.join(grid, key, "left")
        right = right.withColumn("_salt", F.pmod(F.xxhash64(right_id), salts).cast("int"))
        right = right.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_salts", "_parts")
        joined = left.join(right, [key, "_salt", "_part"]).drop("_salt", "_part")
    return joined if condition is None else joined.filter(condition)
