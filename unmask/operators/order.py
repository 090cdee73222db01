"""Positions of rows in a sorted frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from unmask.session import durable


def with_position(df: DataFrame, position: str = "position") -> DataFrame:
    """The rows of a sorted frame, numbered from 1 in the order in which they come.

    The sort is distributed; a task numbers its own rows and adds how many lie before its range, so the
    driver and a single task see one row for each range only.
    """
    ordered = durable(df.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    own = F.col("_at") - F.shiftleft(part, 33) + 1
    rows = ordered.withColumn("_part", part).join(offsets, "_part")
    return rows.withColumn(position, (F.col("_offset") + own).cast("long")).drop("_at", "_part", "_offset")
