"""Column statistics: profile, summary, histogram, accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, is_list, n_rows, n_filled) for every column, in one pass."""
    total = F.count(F.lit(1)).alias("n_rows")
    counts = df.agg(total, *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(isinstance(f.dataType, T.ArrayType)).alias("is_list"),
                F.col("n_rows"),
                F.col(f"n{i}").alias("n_filled"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def text_summary(df: DataFrame, column: str) -> DataFrame:
    """(n, n_distinct, top, top_count): what a text column mostly holds; ties go to the smaller text."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    best = F.min(F.struct((-F.col("c")).alias("c"), F.col("v"))).alias("best")
    return counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_distinct"), best).select(
        "n", "n_distinct", F.col("best.v").alias("top"), (-F.col("best.c")).alias("top_count")
    )


def number_summary(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column).cast("double")
    return df.agg(
        F.count(c).alias("n"),
        F.round(F.avg(c), 4).alias("mean"),
        F.round(F.stddev_samp(c), 4).alias("std"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    )


def histogram(df: DataFrame, value: Column, width: float, out: str = "bucket") -> DataFrame:
    """Rows per bucket of the given width; a bucket is named by its lower bound's index."""
    return (
        df.select(F.floor(value / width).cast("bigint").alias(out))
        .filter(F.col(out).isNotNull())
        .groupBy(out)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    wrong = F.col(label) != F.col(predicted)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(wrong).alias("n_wrong"),
        F.round(F.avg((~wrong).cast("double")), 4).alias("accuracy"),
    )
