"""From matcher output to the result tables: availability, savings, descriptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unmask.functions import scalars as sc

GOOD = "Good"
RESULT_COLUMNS = [
    "stockcode_x",
    "stockcode_y",
    "description",
    "varietal",
    "bottle_closure",
    "price_before",
    "price_after",
    "savings",
]


def union_matches(*matches: DataFrame) -> DataFrame:
    """Matches of several matchers in one frame; columns one of them lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), matches)


def good_only(matches: DataFrame) -> DataFrame:
    return matches.filter(sc.contains_text(F.col("match_level"), GOOD))


def deliverable(catalogue: DataFrame) -> DataFrame:
    return catalogue.filter(F.coalesce(F.col("is_for_delivery"), F.lit(False)))


def by_savings(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc_nulls_last("savings"), "stockcode_x", "stockcode_y")


def by_level_and_savings(df: DataFrame) -> DataFrame:
    return df.orderBy(F.asc("match_level"), F.desc_nulls_last("savings"), "stockcode_x", "stockcode_y")


def _descriptions(catalogue: DataFrame) -> DataFrame:
    return catalogue.select(F.col("stockcode").alias("stockcode_y"), "description").distinct()


def assemble(catalogue: DataFrame, matches: DataFrame, how: str = "inner") -> DataFrame:
    """Good matches of deliverable products with savings and the known product's description.

    ``how="left"`` keeps deliverable products without a match too.
    """
    avail = deliverable(catalogue).select(
        F.col("stockcode").alias("stockcode_x"), "varietal", "bottle_closure", "price_before", "price_after"
    )
    pairs = good_only(matches).select("stockcode_x", "stockcode_y").distinct()
    out = avail.join(pairs, "stockcode_x", how).join(_descriptions(catalogue), "stockcode_y", "left")
    out = out.withColumn("savings", sc.saving(F.col("price_before"), F.col("price_after")))
    return by_savings(out.select(*RESULT_COLUMNS).distinct())


def all_deals(catalogue: DataFrame) -> DataFrame:
    """Deliverable mysteries with their savings."""
    out = deliverable(catalogue).filter("mystery").withColumn(
        "savings", sc.saving(F.col("price_before"), F.col("price_after"))
    )
    return out.select(
        "stockcode", "description", "varietal", "bottle_closure", "price_before", "price_after", "savings"
    ).orderBy(F.desc_nulls_last("savings"), "stockcode")


def enrich_both(
    catalogue: DataFrame,
    matches: DataFrame,
    columns: list[str],
    savings: Column | None = None,
    only_good: bool = True,
) -> DataFrame:
    """Matches with columns of both products, suffixed ``_x`` and ``_y``; the mystery must be deliverable.

    ``savings`` is an expression over the mystery's columns, by default single minus promo price.
    """
    savings = sc.saving(F.col("price_single"), F.col("price_promo")) if savings is None else savings
    side_x = deliverable(catalogue).withColumn("savings", savings).select(
        F.col("stockcode").alias("stockcode_x"), *[F.col(c).alias(f"{c}_x") for c in columns], "savings"
    )
    side_y = catalogue.select(F.col("stockcode").alias("stockcode_y"), *[F.col(c).alias(f"{c}_y") for c in columns])
    kept = good_only(matches) if only_good else matches
    out = kept.select("stockcode_x", "stockcode_y", "method", "match_level")
    return by_level_and_savings(out.join(side_x, "stockcode_x").join(side_y, "stockcode_y"))


def shortlist(catalogue: DataFrame, attribute: str, value: str, columns: list[str]) -> DataFrame:
    """Deliverable mysteries with one attribute value, such as a closure."""
    return deliverable(catalogue).filter(F.col("mystery") & (F.col(attribute) == value)).select(*columns)


def solve_rate(catalogue: DataFrame, matches: DataFrame) -> DataFrame:
    """Mysteries, matched mysteries and their share."""
    solved = good_only(matches).select(F.col("stockcode_x").alias("stockcode")).distinct()
    solved = solved.withColumn("_hit", F.lit(1))
    return (
        catalogue.filter("mystery")
        .select("stockcode")
        .distinct()
        .join(solved, "stockcode", "left")
        .agg(F.count(F.lit(1)).alias("n_mystery"), F.count("_hit").alias("n_solved"))
        .withColumn("solve_rate", F.round(F.col("n_solved") / F.col("n_mystery"), 4))
    )
