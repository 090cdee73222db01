"""Readers for the landed files and tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unmask.functions import scalars as sc
from unmask.sources import schema as sch

_RECORD = "_record"


def read_csv(
    spark: SparkSession, paths: str | list[str], schema: T.StructType, strict: bool = False, multi_line: bool = True
) -> DataFrame:
    """CSV with a header. Rows with too many fields are skipped, short rows are filled with null.

    ``strict`` raises on any row that does not fit. ``multi_line`` allows line ends inside quotes, which
    makes each file one task; without it large files are split.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if strict:
        return reader.schema(schema).option("mode", "FAILFAST").csv(paths)
    kept = T.StructType([*schema.fields, T.StructField(_RECORD, T.StringType())])
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD)
    rows = reader.schema(kept).csv(paths)
    # The record is kept where a row does not fit; commas outside of quotes separate its fields.
    bare = F.regexp_replace(_RECORD, '"(?:[^"]|"")*"', "")
    fields = F.regexp_count(bare, F.lit(",")) + 1
    return rows.filter(F.col(_RECORD).isNull() | (fields <= len(schema.fields))).drop(_RECORD)


def read_payload(spark: SparkSession, paths: str | list[str], schema: T.StructType = sch.PAYLOAD) -> DataFrame:
    """Product payload files, one JSON object per line."""
    return spark.read.schema(schema).json(paths)


def read_sitemap(spark: SparkSession, path: str, marker: str = "/product") -> DataFrame:
    """(url): product links of a sitemap, read as lines so that a large file still splits."""
    lines = spark.read.text(path)
    urls = lines.select(F.explode(F.regexp_extract_all("value", F.lit("<loc>([^<]+)"), 1)).alias("url"))
    return urls.filter(sc.contains_text(F.col("url"), marker))


def read_lines(spark: SparkSession, path: str, column: str = "url") -> DataFrame:
    """A headerless one-column list."""
    return spark.read.text(path).withColumnRenamed("value", column)


def page_links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, link): every link of every landed page, in page order with repeats."""
    return pages.select(key, F.explode(sc.links_in_page(F.col(html))).alias("link"))


def read_jdbc(
    spark: SparkSession,
    url: str,
    query_or_table: str,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Database scan split over a column; credentials come in through ``properties``."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", query_or_table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .options(**(properties or {}))
        .load()
    )


def table_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table)]


def read_run(spark: SparkSession, path: str, day: Column) -> DataFrame:
    """One run of a table partitioned by ``run_date``; other partitions are not listed or read."""
    return spark.read.parquet(path).filter(F.col("run_date") == day)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
