"""Incremental load and matching of landed files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def landed_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", files_per_batch: int = 1000) -> DataFrame:
    """Stream of the files under a path or glob; each file is picked up once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def load_new_files(
    stream: DataFrame, table: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Run the stream until all landed files are in the table, then stop.

    A micro-batch is written to its own partition and replaces it when it is repeated after a
    failure, so nothing is loaded twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        (
            rows.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(table)
        )

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def match_new_files(
    stream: DataFrame, known: DataFrame, matcher: Callable[[DataFrame, DataFrame], DataFrame], table: str, checkpoint: str
) -> None:
    """Match each batch of landed mysteries against the current known table."""
    load_new_files(stream, table, checkpoint, lambda batch: matcher(batch, known))


def first_seen_in_batch(batch: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Distinct keys of a batch that the history lacks; exact, with no state kept in the stream."""
    return batch.select(key).distinct().join(history.select(key).distinct(), key, "left_anti")


def first_seen_within(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Streaming form with bounded state: repeats of a key within the delay are dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def keep_first_seen(stream: DataFrame, key: str, ts: str, delay: str, table: str, checkpoint: str) -> None:
    """Append each key's first row to the table, until all landed files are read.

    Keys seen are state in the checkpoint, so a later run goes on where this one stopped: repeats of earlier
    runs are dropped too, and so are rows later than the watermark. A key's state ends ``delay`` after its row.
    """
    rows = first_seen_within(stream, key, ts, delay)
    query = (
        rows.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
