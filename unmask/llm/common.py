"""Small things that several operators share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than ASCII white space (space and U+0009 to U+000D).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until the frame has no such column (any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def cols(df: DataFrame, leave: set[str] | tuple[str, ...] = ()) -> list[Column]:
    """The frame's columns except those named in ``leave`` (any case), safe for odd names."""
    gone = {c.lower() for c in leave}
    return [quoted(c) for c in df.columns if c.lower() not in gone]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def word_count(text: Column) -> Column:
    """Words of a text as a long; none in a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(df: DataFrame, group: list[str], part: str, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows of the group, by (part, order).

    ``part`` cuts every group into pieces that one task can hold. Sums of whole pieces are added
    over the pieces, and rows only within their piece, so that a group of any size is spread.
    """
    from pyspark.sql import Window as W

    sums = df.groupBy(*group, part).agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(*group).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    within = W.partitionBy(*group, part).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rows = df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    keys = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in [*group, part]]
    on = keys[0]
    for k in keys[1:]:
        on = on & k
    joined = rows.alias("_l").join(sums.alias("_r"), on)
    return joined.select("_l.*", (F.col("_r._before") + F.col("_within")).alias(out)).drop("_within")


def url_host(url: Column) -> Column:
    """Lower-cased host of a URL; null without one."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


_SPACE = " \t\n\x0b\x0c\r"
_NOT_ASCII_SPACE = re.compile(WORD)


def ascii_words(text: str) -> list[str]:
    return _NOT_ASCII_SPACE.findall(text)


def word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, _SPACE))
