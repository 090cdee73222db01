"""Writers for snapshots, matches and models."""

from __future__ import annotations

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame

JDBC_BATCH = 1_000
# Records of a CSV file: one with line ends inside quotes is read by one task.
CSV_RECORDS = 100_000


def append_run(df: DataFrame, path: str) -> None:
    """Append a run to a Parquet table partitioned by ``run_date``."""
    df.write.mode("append").partitionBy("run_date").parquet(path)


def replace_run(df: DataFrame, path: str) -> None:
    """Write a run so that repeating it replaces its own partitions only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def append_table(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def overwrite_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Batched inserts; credentials come in through ``properties``."""
    options = {"batchsize": str(JDBC_BATCH), **(properties or {})}
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode("append").save()


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, records: int = CSV_RECORDS) -> None:
    """CSV files with a header, of at most so many records each."""
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').option("maxRecordsPerFile", records).csv(path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)
