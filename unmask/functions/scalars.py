"""Scalar expressions for catalogue columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: prefix the shop puts before a stock code in product links.
CODE_PREFIX = "DM_"


def stock_code_from_url(url: Column) -> Column:
    """Stock code of a product link, with or without the code prefix; null for other links."""
    return F.nullif(F.regexp_extract(url, rf"/product/(?:{CODE_PREFIX})?([^/<\s?#]+)", 1), F.lit(""))


def page_code_from_url(url: Column, marker: str) -> Column:
    """The path part that follows ``marker``, up to the next separator; null if absent."""
    return F.nullif(F.regexp_extract(url, f"{marker}([^/<?#]+)", 1), F.lit(""))


def prefixed_code(code: Column, prefix: str = CODE_PREFIX) -> Column:
    """Code with its prefix; null stays null."""
    return F.concat(F.lit(prefix), code)


def product_link(code: Column, base_url: str) -> Column:
    return F.when(code.isNull(), F.lit("None")).otherwise(F.concat(F.lit(base_url), code.cast("string")))


def links_in_page(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('href="([^"]+)"'), 1)


def leading_number(text: Column) -> Column:
    """The one to four digits a text starts with, or null."""
    return F.nullif(F.regexp_extract(text, r"^([0-9]{1,4})", 1), F.lit("")).cast("int")


def as_number(value: Column) -> Column:
    return value.try_cast("double")


def as_flag(value: Column) -> Column:
    """Boolean flag; a missing flag counts as false."""
    return F.coalesce(value.try_cast("boolean"), F.lit(False))


def money(value: Column) -> Column:
    return value.cast("decimal(18,4)")


def saving(before: Column, after: Column) -> Column:
    """Price difference to two places; null if either price is missing."""
    return F.round(money(before) - money(after), 2)


def contains_text(value: Column, part: str) -> Column:
    """Case-sensitive substring test; a missing text does not contain anything."""
    return F.coalesce(F.contains(value, F.lit(part)), F.lit(False))


def contains_any_case(value: Column, part: str) -> Column:
    return F.coalesce(F.contains(F.lower(value), F.lit(part.lower())), F.lit(False))


def is_none_of(value: Column, denied: list[str]) -> Column:
    """Deny-list test that keeps rows without a value."""
    keep = F.lit(True)
    for item in denied:
        keep = keep & ~value.eqNullSafe(F.lit(item))
    return keep


# Texts that mark a masked product.
MASKED_DESCRIPTION = "Wraps"
MASKED_CODE = "MYSTERY"


def is_masked(description: Column, code: Column | None = None, rule: str = "description") -> Column:
    """Mystery flag from the description (either case rule) or from the stock code."""
    if rule == "description":
        return contains_text(description, MASKED_DESCRIPTION)
    if rule == "description_any_case":
        return contains_any_case(description, MASKED_DESCRIPTION)
    if rule == "code":
        return contains_text(code, MASKED_CODE)
    raise ValueError(f"unknown rule {rule!r}")


def clean_identifier(name: str) -> str:
    """Column name without brackets and less-than signs."""
    return re.sub(r"[\[\]<]", "_", name)


def snake_case(name: str) -> str:
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return re.sub(r"[^0-9a-z]+", "_", spaced.lower()).strip("_")
