"""Which products to load: new links plus everything still masked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unmask.functions import scalars as sc
from unmask.operators import snapshots as snap


def refresh_list(
    today: DataFrame, yesterday: DataFrame, snapshot: DataFrame, url: str = "url", always: str = sc.MASKED_DESCRIPTION
) -> DataFrame:
    """(stockcode): codes of new or masked links, and of every mystery ever loaded."""
    new = snap.new_lines(today, yesterday, url).select(url)
    masked = today.filter(sc.contains_any_case(F.col(url), always)).select(url)
    codes = new.unionByName(masked).select(sc.stock_code_from_url(F.col(url)).alias("stockcode"))
    known = snapshot.filter("mystery").select("stockcode")
    return snap.with_always_refreshed(codes, known, "stockcode")
