"""Report tables: what is new, what is active, what is on offer."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unmask.functions import scalars as sc
from unmask.operators import snapshots as snap

# snapshot column behind each report column that is copied as it is
COPIED = {
    "promo_type": "price_message",
    "normal_price": "price_before",
    "promo_price": "price_after",
    "closure": "bottle_closure",
    "likely_producer": "producer",
    "state": "state",
    "vintage": "vintage",
}
REPORT_COLUMNS = [
    "varietal", "mystery", "solved", "description", "solved_description", "promo_type", "normal_price",
    "promo_price", "savings", "closure", "likely_producer", "state", "vintage",
]


def latest_matches(matches: DataFrame, by_date: bool = False) -> DataFrame:
    """Matches of the newest run, or of the newest run date; one row per distinct pair."""
    newest = snap.latest_load_value(matches, "updated")
    if by_date:
        out = matches.filter(F.to_date("updated") == F.to_date(F.lit(newest)))
    else:
        out = matches.filter(F.col("updated") == F.lit(newest))
    return out.select("stockcode_x", "stockcode_y", F.col("description").alias("solved_description")).distinct()


def _active(rows: DataFrame) -> DataFrame:
    flag = sc.as_flag
    return rows.filter(flag(F.col("mystery").cast("string")) & flag(F.col("is_for_delivery").cast("string")))


def _report(rows: DataFrame, matches: DataFrame, extra: list[Column] | None = None) -> DataFrame:
    joined = rows.join(matches, rows["stockcode"] == matches["stockcode_x"], "left")
    return joined.select(
        *(extra or []),
        "varietal",
        sc.prefixed_code(F.col("stockcode")).alias("mystery"),
        sc.prefixed_code(F.col("stockcode_y")).alias("solved"),
        "description",
        "solved_description",
        *[F.col(c).alias(out) for out, c in COPIED.items()],
        sc.saving(F.col("price_before"), F.col("price_after")).alias("savings"),
    ).select(*([c for c in (["first_appeared", "_first"] if extra else [])]), *REPORT_COLUMNS)


def _by_varietal(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("varietal"), F.desc("savings"), "mystery", "solved")


def new_items(
    snapshot: DataFrame,
    matches: DataFrame,
    as_of: date | datetime | None = None,
    window_days: int = 0,
    promo: bool | None = None,
    by_date: bool | None = None,
) -> DataFrame:
    """Deliverable mysteries of the latest load that were not seen before ``as_of - window_days``.

    ``window_days=0`` reports what is new today. ``promo`` keeps items with (True) or without
    (False) a promotion price. By default the one-day report compares dates and the windowed
    ones compare full load times. ``as_of`` defaults to the latest load.
    """
    by_date = window_days == 0 if by_date is None else by_date
    newest = snap.latest_load_value(snapshot)
    day = F.date_sub(F.to_date(F.lit(newest if as_of is None else as_of)), window_days)
    if by_date:
        current = snapshot.filter(F.to_date("load_ts") == F.to_date(F.lit(newest)))
    else:
        current = snapshot.filter(F.col("load_ts") == F.lit(newest))
    current = _active(current)
    if promo is not None:
        current = current.filter(F.col("price_after").isNotNull() if promo else F.col("price_after").isNull())
    fresh = snap.not_seen_before(current, snapshot, "stockcode", "load_ts", day)
    return _by_varietal(_report(fresh, latest_matches(matches, by_date)))


def single_load_items(
    snapshot: DataFrame, matches: DataFrame, since: date | datetime, promo: bool | None = None
) -> DataFrame:
    """Rows of mysteries loaded since a date whose stock code occurs at one load time only."""
    recent = _active(snapshot.filter(F.to_date("load_ts") >= F.to_date(F.lit(since)))).select("stockcode").distinct()
    once = snap.single_load_keys(snapshot, "stockcode", "load_ts").join(recent, "stockcode", "left_semi")
    rows = _active(snapshot.join(once, "stockcode", "left_semi"))
    if promo is not None:
        rows = rows.filter(F.col("price_after").isNotNull() if promo else F.col("price_after").isNull())
    return _by_varietal(_report(rows, latest_matches(matches)))


def active_with_first_seen(snapshot: DataFrame, matches: DataFrame) -> DataFrame:
    """Deliverable mysteries on offer in the latest load, with the day they first appeared."""
    newest = snap.latest_load_value(snapshot)
    current = _active(snapshot.filter(F.col("load_ts") == F.lit(newest))).filter("price_after is not null")
    codes = current.select("stockcode").distinct()
    history = snapshot.select("stockcode", "load_ts").join(codes, "stockcode", "left_semi")
    rows = current.join(snap.first_seen(history, "stockcode", "load_ts"), "stockcode")
    first = [F.date_format("first_seen", "yyyy MM dd").alias("first_appeared"), F.col("first_seen").alias("_first")]
    out = _report(rows, latest_matches(matches), first).distinct()
    return out.orderBy(F.desc("varietal"), F.desc("_first"), F.desc("savings"), "mystery", "solved").drop("_first")


def offers_among_deliverable(giveaways: DataFrame, deliverable: DataFrame) -> DataFrame:
    """Natural join: give-aways that are deliverable, on all columns both frames have."""
    common = [c for c in giveaways.columns if c in deliverable.columns]
    return giveaways.join(deliverable, common)
