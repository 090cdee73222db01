"""Snapshot operators: latest, first seen, keep-last, day differences and schema alignment.

None of them gathers one key in one task: every step is either an aggregate with map-side
combine or a join on keys that also spread a frequent item over its load times.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_load(df: DataFrame, ts: str = "load_ts") -> DataFrame:
    return df.agg(F.max(ts).alias(ts))


def latest_load_value(df: DataFrame, ts: str = "load_ts") -> datetime | date | None:
    """The newest load time as one value, so that later filters reach the scan as literals."""
    return latest_load(df, ts).first()[0]


def latest_per_key(df: DataFrame, key: str, ts: str) -> DataFrame:
    """All rows of each key at its newest time; ties are kept.

    The join runs on (key, time): the rows of one frequent key spread over their times.
    """
    newest = df.groupBy(key).agg(F.max(ts).alias(ts))
    return df.join(newest, [key, ts], "left_semi")


def first_seen(df: DataFrame, key: str, ts: str, out: str = "first_seen") -> DataFrame:
    return df.groupBy(key).agg(F.min(ts).alias(out))


def not_seen_before(df: DataFrame, history: DataFrame, key: str, ts: str, day: Column) -> DataFrame:
    """Rows whose key has no history entry dated before ``day``."""
    old = history.filter(F.to_date(ts) < day).select(key).distinct()
    return df.join(old, key, "left_anti")


def single_load_keys(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Keys that occur at one load time only."""
    span = df.groupBy(key).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    return span.filter(F.col("_lo") == F.col("_hi")).select(key)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last in the given order, remaining columns break ties."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.max(F.struct(*order, *rest)).alias("_row")
    out = df.groupBy(*keys).agg(packed).select(*keys, "_row.*")
    return out.select(*df.columns)


def occurring_once(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Value combinations that occur exactly once; nulls count as equal."""
    columns = columns or df.columns
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").select(*columns)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def symmetric_difference(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """Rows found once over both days, with the side they came from."""
    tagged = before.select(*columns, F.lit("removed").alias("side")).unionByName(
        after.select(*columns, F.lit("added").alias("side"))
    )
    counted = tagged.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"), F.min("side").alias("side"))
    return counted.filter("_n = 1").drop("_n")


def new_lines(today: DataFrame, yesterday: DataFrame, column: str) -> DataFrame:
    """Today's lines that yesterday lacks; repeats of a new line are kept."""
    return today.join(yesterday.select(column).distinct(), column, "left_anti")


def with_always_refreshed(new: DataFrame, always: DataFrame, column: str) -> DataFrame:
    return new.select(column).union(always.select(column)).na.drop().distinct()


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly the target's columns: unknown ones go, absent ones become null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.fields
        ]
    )


def rolling_union(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Previous and current catalogue in one frame; columns either side lacks become null."""
    return previous.unionByName(current, allowMissingColumns=True)


def pivot_attributes(df: DataFrame, key: str, name: str, value: str, names: list[str]) -> DataFrame:
    """One row per key, one column per attribute; a repeated attribute yields its smallest value."""
    return df.groupBy(key).pivot(name, names).agg(F.min(value))
