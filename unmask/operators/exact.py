"""Exact text matching and the give-away filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unmask.functions import scalars as sc
from unmask.session import durable

# Review texts that stand for "no text".
PLACEHOLDER_REVIEWS = ["[..]", "[...]", "[....]"]

# Text column and the method name of its match.
TEXT_METHODS = {
    "rich_description": "desc_match",
    "web_description_short": "webdesc_match",
    "review1_text": "rev_match",
    "review2_text": "rev2_match",
}


def giveaway(
    df: DataFrame,
    description: str = "description",
    product_name: str = "web_product_name",
    deliverable: str = "is_for_delivery",
    marker: str = sc.MASKED_DESCRIPTION,
) -> DataFrame:
    """Masked products whose own product name gives them away."""
    return df.filter(
        F.col(product_name).isNotNull()
        & sc.contains_text(F.col(description), marker)
        & ~sc.contains_text(F.col(product_name), marker)
        & F.coalesce(F.col(deliverable), F.lit(False))
    ).withColumn("method", F.lit("giveaway"))


def without_placeholders(df: DataFrame, mystery: str, reviews: list[str]) -> DataFrame:
    """Drop known rows with a placeholder in any review; missing reviews stay."""
    keep = F.lit(True)
    for column in reviews:
        keep = keep & sc.is_none_of(F.col(column), PLACEHOLDER_REVIEWS)
    return df.filter(F.col(mystery) | keep)


def text_groups(df: DataFrame, key: str, mystery: str, methods: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows (method, match_key, key, mystery) and the groups that have both sides."""
    rows = durable(text_rows(df, key, mystery, methods), "texts")
    groups = (
        rows.groupBy("method", "match_key")
        .agg(
            F.count_if("mystery").alias("n_mystery"),
            F.count_if(~F.col("mystery")).alias("n_known"),
            F.min(F.when(~F.col("mystery"), F.col("stockcode"))).alias("first_known"),
        )
        .filter("n_mystery > 0 and n_known > 0")
    )
    return rows, groups


def text_rows(df: DataFrame, key: str, mystery: str, methods: dict[str, str]) -> DataFrame:
    """Distinct (stockcode, mystery, method, match_key).

    ``match_key`` is a digest of the whole text, so long texts do not travel through shuffles.
    """
    # blank texts match nothing
    stack = F.array(
        *[
            F.struct(
                F.lit(name).alias("method"),
                F.when(F.trim(F.col(c)) != "", F.sha2(F.col(c), 256)).alias("match_key"),
            )
            for c, name in methods.items()
        ]
    )
    rows = df.select(F.col(key).alias("stockcode"), F.col(mystery).alias("mystery"), F.explode(stack).alias("t"))
    return rows.select("stockcode", "mystery", "t.method", "t.match_key").filter("match_key is not null").distinct()


def known_texts(rows: DataFrame) -> DataFrame:
    """(method, match_key, n_known, stockcode_y) of every known text; the code is the smallest."""
    return rows.filter("not mystery").groupBy("method", "match_key").agg(
        F.count(F.lit(1)).alias("n_known"), F.min("stockcode").alias("stockcode_y")
    )


def match_texts(masked: DataFrame, known: DataFrame) -> DataFrame:
    """One row for each mystery, method and text that known products share."""
    found = masked.filter("mystery").select("method", "match_key", F.col("stockcode").alias("stockcode_x"))
    return found.join(known, ["method", "match_key"]).select(
        "stockcode_x", "stockcode_y", "method", F.lit("Good").alias("match_level"), "match_key", "n_known"
    )


def exact_text_match(
    df: DataFrame,
    key: str = "stockcode",
    mystery: str = "mystery",
    methods: dict[str, str] | None = None,
    reviews: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Mystery and known products with an identical text in the same column.

    Returns (matches, members), both in linear size whatever the groups of copies. ``matches`` has one
    row for each mystery, method and match_key, with the number of known products that share the text
    and the smallest of their codes; ``members`` lists them all under the same (method, match_key).
    """
    methods = methods or TEXT_METHODS
    if reviews is None:
        reviews = [c for c in methods if c.startswith("review")]
    rows, groups = text_groups(without_placeholders(df, mystery, reviews), key, mystery, methods)
    matches = match_texts(rows, known_texts(rows))
    members = rows.filter("not mystery").join(groups.select("method", "match_key"), ["method", "match_key"], "left_semi")
    return matches, members.select("method", "match_key", "stockcode")


def candidate_counts(df: DataFrame, key: str, mystery: str, blocking: list[str]) -> DataFrame:
    """How many known products agree with each mystery on all blocking columns."""
    known = df.filter(~F.col(mystery)).groupBy(*blocking).agg(F.count(F.lit(1)).alias("n_known"))
    masked = df.filter(F.col(mystery)).select(F.col(key).alias("stockcode_x"), *blocking)
    return masked.join(known, blocking, "left").select("stockcode_x", F.coalesce("n_known", F.lit(0)).alias("n_known"))
