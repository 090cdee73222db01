"""Nested product payload to the wide snapshot row, without a shuffle but the keep-last."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unmask.functions import scalars as sc
from unmask.operators.snapshots import keep_last
from unmask.session import spread_by
from unmask.sources import schema as sch

# Stock codes and texts of products that are left out.
DENIED_CODES = ["ER_2000003422_RX2386", "ER_1000004375_CALSG16"]
DENIED_CODE_PART = "672366"
DENIED_DESCRIPTION = "Secret Selection"


# A quoted string with its escapes, or a stretch without quotes.
_LITERAL_PARTS = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^'"]+"""


def literal_cell(cell: Column, data_type: T.DataType) -> Column:
    """Parse a cell written as a Python literal by way of JSON; text is never evaluated.

    Strings in either quotes become JSON strings with their escapes; None, True and False count only
    outside of strings. A cell that cannot be parsed becomes null.
    """

    def string(part: Column) -> Column:
        inner = F.substring(part, F.lit(2), F.length(part) - 2)
        # An escaped backslash first, so that what follows it is not taken for an escape.
        for pattern, value in (
            (r"\\\\", r"\\u005c"), (r"\\'", "'"), (r'\\"', r"\\u0022"), (r'"', r"\\u0022"),
            (r"\\x([0-9a-fA-F]{2})", r"\\u00$1"), (r"\\a", r"\\u0007"), (r"\\v", r"\\u000b"), (r"\\0", r"\\u0000"),
        ):
            inner = F.regexp_replace(inner, pattern, value)
        return F.concat(F.lit('"'), inner, F.lit('"'))

    def bare(part: Column) -> Column:
        for token, value in (("None", "null"), ("True", "true"), ("False", "false")):
            part = F.regexp_replace(part, rf"\b{token}\b", value)
        return part

    parts = F.regexp_extract_all(cell, F.lit(_LITERAL_PARTS), F.lit(0))
    json = F.transform(parts, lambda p: F.when(p.rlike("^['\"]"), string(p)).otherwise(bare(p)))
    return F.from_json(F.array_join(json, ""), data_type, {"mode": "PERMISSIVE", "allowUnquotedControlChars": "true"})


def failed_cells(df: DataFrame, cell: str, data_type: T.DataType) -> DataFrame:
    """Rows whose literal cell holds text that does not parse, for quarantine."""
    return df.filter(F.col(cell).isNotNull() & literal_cell(F.col(cell), data_type).isNull())


def nth_field(items: Column, position: int, *path: str) -> Column:
    """Field of the n-th list element, or null when the list is shorter."""
    out = F.get(items, F.lit(position))
    for step in path:
        out = out.getField(step)
    return out


def categories(items: Column) -> list[Column]:
    return [
        nth_field(items, 0, "UrlFriendlyName").alias("category"),
        nth_field(items, 1, "UrlFriendlyName").alias("sub_category"),
    ]


def reviews(items: Column) -> list[Column]:
    return [
        nth_field(items, i, field, "Value").alias(f"review{i + 1}_{suffix}")
        for i in range(sch.REVIEWS_KEPT)
        for field, suffix in sch.REVIEW_FIELDS.items()
    ]


def attribute_map(details: Column) -> Column:
    """Name to value of a row's own attribute list; the smallest value if a name repeats."""
    entries = F.transform(details, lambda d: F.struct(d["Name"].alias("key"), d["Value"].alias("value")))
    # Nulls sort first and are left out, so the first entry of a name is its smallest value.
    entries = F.array_sort(F.filter(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull()))
    first = F.filter(entries, lambda e, i: (i == 0) | (F.get(entries, i - 1)["key"] != e["key"]))
    return F.map_from_entries(first)


def products(payload: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per product of the payload's ``Products`` list, ``carry`` columns kept."""
    carried = [F.col(c) for c in carry or []]
    return payload.select(*carried, F.explode("Products").alias("p")).select(*(carry or []), "p.*")


def exploded_details(df: DataFrame, key: str = "Stockcode", details: str = "AdditionalDetails") -> DataFrame:
    """(key, Name, Value): the attribute list in long form; empty lists yield one empty row."""
    return df.select(key, F.explode_outer(details).alias("d")).select(key, "d.Name", "d.Value")


def flatten_products(
    df: DataFrame,
    order: list[str],
    attributes: list[str] | None = None,
    mystery_rule: str = "description",
    only_categories: list[str] | None = None,
    denied_codes: list[str] = DENIED_CODES,
    denied_code_part: str | None = DENIED_CODE_PART,
    denied_description: str | None = DENIED_DESCRIPTION,
) -> DataFrame:
    """Wide rows from product structs, one per stock code (the last in ``order``).

    Products with an empty or missing attribute list, denied codes and denied descriptions are
    left out. Attribute columns come from the row's own list, so the pivot needs no shuffle.
    """
    names = sch.ATTRIBUTES if attributes is None else attributes
    df = df.filter(sc.is_none_of(F.col("Stockcode"), denied_codes))
    if denied_code_part:
        df = df.filter(~sc.contains_text(F.col("Stockcode"), denied_code_part))
    if denied_description:
        df = df.filter(~sc.contains_text(F.col("Description"), denied_description))
    if only_categories:
        df = df.filter(nth_field(F.col("Categories"), 0, "UrlFriendlyName").isin(only_categories))
    # the last product of a code is chosen before the many columns are made; the wide rows are dealt by code
    # first, so that no task sorts all that it has read
    df = keep_last(spread_by(df.filter(F.size("AdditionalDetails") > 0), "Stockcode"), ["Stockcode"], order)
    df = df.withColumn("_attributes", attribute_map(F.col("AdditionalDetails")))
    have = set(df.columns)
    plain = [
        F.col(f.name).alias(sch.flat_name(f.name))
        for f in sch.PRODUCT.fields
        if f.name in have and not isinstance(f.dataType, (T.StructType, T.ArrayType))
    ]
    nested = [
        F.col(f"{outer}.{f.name}").alias(sch.flat_name(prefix, f.name))
        for outer, prefix in (("Inventory", "inventory"), ("PickupStoreInventoryInfo", "pickup"))
        if outer in have
        for f in df.schema[outer].dataType.fields
    ]
    prices = [
        F.col(f"Prices.{kind}.{f}").alias(sch.flat_name("price", kind, f))
        for kind in sch.PRICE_KINDS
        if "Prices" in have and kind in df.schema["Prices"].dataType.names
        for f in sch.PRICE_FIELDS
    ]
    return df.select(
        *plain,
        *(categories(F.col("Categories")) if "Categories" in have else []),
        *(reviews(F.col("Reviews")) if "Reviews" in have else []),
        *prices,
        *([F.to_json("Inventory").alias("inventory")] if "Inventory" in have else []),
        *nested,
        *[F.col("_attributes")[a].alias(sch.flat_name(a)) for a in names],
        sc.is_masked(F.col("Description"), F.col("Stockcode"), mystery_rule).alias("mystery"),
    )


def stamp(df: DataFrame, load_ts: datetime) -> DataFrame:
    """Every row of a load carries the same load time and run date."""
    return df.withColumn("load_ts", F.lit(load_ts).cast("timestamp")).withColumn("run_date", F.to_date("load_ts"))
