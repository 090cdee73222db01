"""Catalogue-shaped views over the benchmark tables, whole tables each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from unmask.functions import scalars as sc
from unmask.sources import schema as sch


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def day_of(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def event_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Product snapshots: one load per day, a stock code per user and property value."""
    k = F.get_json_object("props", "$.k")
    price = F.col("value").cast("decimal(12,2)")
    return table(spark, folder, "events").select(
        F.concat(F.lit("ER_"), F.col("user_id").cast("string"), F.lit("_"), k).alias("stockcode"),
        day_of(F.col("ts")).alias("load_ts"),
        F.col("event_type").alias("varietal"),
        F.col("props").alias("description"),
        F.when(F.col("value") >= 20, F.concat(F.lit("save "), "event_type")).alias("price_message"),
        price.alias("price_before"),
        F.when(F.col("value") >= 20, F.floor("value").cast("decimal(12,2)")).alias("price_after"),
        F.col("event_type").isin("view", "click", "signup").alias("mystery"),
        (F.col("value") < 100).alias("is_for_delivery"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("producer"),
        F.lit("cork").alias("bottle_closure"),
        F.col("event_type").alias("state"),
        k.alias("vintage"),
    )


def event_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Match results: one run per day."""
    return table(spark, folder, "events").filter("value > 5").select(
        F.concat(
            F.lit("ER_"), F.col("user_id").cast("string"), F.lit("_"), F.get_json_object("props", "$.k")
        ).alias("stockcode_x"),
        F.concat(F.lit("P"), F.col("event_id").cast("string")).alias("stockcode_y"),
        F.col("props").alias("description"),
        day_of(F.col("ts")).alias("updated"),
    )


def part_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as products; a widget hides what it is."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("stockcode"),
        F.col("p_name").alias("description"),
        F.col("p_type").alias("varietal"),
        F.col("p_brand").alias("bottle_closure"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price_before"),
        F.when(F.col("p_type") != "PROMO", F.col("p_retailprice") - F.col("p_size"))
        .cast("decimal(12,2)")
        .alias("price_after"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price_single"),
        (F.col("p_retailprice") - 2 * F.col("p_size")).cast("decimal(12,2)").alias("price_promo"),
        (F.col("p_size") <= 40).alias("is_for_delivery"),
        F.contains("p_name", F.lit("widget")).alias("mystery"),
    )


def part_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Parts written as product payload JSON, one product per line."""
    value = lambda c: F.struct(c.alias("Value"))
    detail = lambda name, c: F.struct(
        F.lit(name).alias("Name"), c.alias("Value"), F.lit(None).cast("string").alias("DisplayName")
    )
    size = F.col("p_size").cast("string")
    product = F.struct(
        F.col("p_partkey").cast("string").alias("Stockcode"),
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("Wraps "), "p_name"))
        .otherwise(F.col("p_name"))
        .alias("Description"),
        (F.col("p_size") <= 40).alias("IsForDelivery"),
        F.col("p_size").cast("long").alias("StockOnHand"),
        F.array(F.struct(F.col("p_type").alias("UrlFriendlyName")), F.struct(F.col("p_brand").alias("UrlFriendlyName")))
        .alias("Categories"),
        F.array(
            F.struct(value(F.col("p_brand")).alias("author"), value(size).alias("points"), value(F.col("p_name")).alias("text"))
        ).alias("Reviews"),
        F.array(
            detail("varietal", F.col("p_type")), detail("webbrandname", F.col("p_brand")), detail("webliquorsize", size)
        ).alias("AdditionalDetails"),
        F.struct(
            F.struct(
                F.col("p_retailprice").cast("decimal(12,2)").alias("BeforePromotion"),
                (F.col("p_retailprice") - F.col("p_size")).cast("decimal(12,2)").alias("AfterPromotion"),
            ).alias("promoprice")
        ).alias("Prices"),
    )
    return table(spark, folder, "part").select(F.to_json(F.struct(F.array(product).alias("Products"))).alias("value"))


def parsed_payload(payload: DataFrame) -> DataFrame:
    return payload.select(F.from_json("value", sch.PAYLOAD).alias("r")).select("r.*")


def literal_details(spark: SparkSession, folder: str) -> DataFrame:
    """Attribute lists written as Python literals, as the flattened result files hold them."""
    quoted = [F.lit("[{'Name': 'varietal', 'Value': '"), "p_type", F.lit("', 'DisplayName': None}, {'Name': 'brand', 'Value': '")]
    cell = F.concat(*quoted, "p_brand", F.lit("', 'DisplayName': None}]"))
    return table(spark, folder, "part").select(F.col("p_partkey").alias("stockcode"), cell.alias("details"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as product texts; those of the sources src1 and src10 to src19 are masked."""
    return table(spark, folder, "documents").withColumn("mystery", F.startswith("source", F.lit("src1")))


def product_urls(spark: SparkSession, folder: str, scheme: str) -> DataFrame:
    """Product links made from the pages of one scheme, one in several carrying the code prefix."""
    pages = table(spark, folder, "pages").filter(F.startswith("url", F.lit(scheme + "://")))
    number = F.regexp_extract("url", "/([0-9]+)", 1)
    lang = F.regexp_extract("url", "//[^/]+/([a-z]+)", 1)
    prefix = F.when(lang == "en", F.lit(sc.CODE_PREFIX)).otherwise(F.lit(""))
    tail = F.when(lang == "es", F.lit("/wraps-of-red")).otherwise(F.lit("/plain"))
    return pages.select(F.concat(F.lit("https://shop.example/product/"), prefix, number, tail).alias("url"))
