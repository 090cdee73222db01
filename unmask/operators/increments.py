"""Latest and first-seen rows kept up load by load.

The table is partitioned into buckets by a hash of the key. A load reads and rewrites the buckets that its
keys fall into and no others, so its cost follows the load and the buckets it touches, not the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unmask.operators import snapshots
from unmask.session import durable

BUCKETS = 64
BUCKET, FIRST = "bucket", "first_seen"


def with_bucket(rows: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))


def table_schema(rows: T.StructType, ts: str) -> T.StructType:
    """The load's columns, the first load time of the key, and the bucket."""
    return T.StructType([*rows.fields, T.StructField(FIRST, rows[ts].dataType), T.StructField(BUCKET, T.IntegerType())])


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, touched: list[int] | None = None) -> DataFrame:
    """The kept-up table, or those of its buckets only; partitions of other buckets are not listed in the scan."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(schema).parquet(path)
    return table if touched is None else table.filter(F.col(BUCKET).isin(touched))


def merged(kept: DataFrame, load: DataFrame, key: str, ts: str) -> DataFrame:
    """Kept rows and a load as one table: all rows of each key at its newest time, and its first time."""
    both = kept.unionByName(load.withColumn(FIRST, F.col(ts)))
    first = both.groupBy(key).agg(F.min(FIRST).alias(FIRST))
    return snapshots.latest_per_key(both.drop(FIRST), key, ts).distinct().join(first, key).select(*kept.columns)


def apply_load(spark: SparkSession, path: str, load: DataFrame, key: str, ts: str, buckets: int = BUCKETS) -> list[int]:
    """Bring a load into the table at ``path``, and return the buckets that were rewritten.

    Rows without a key are left out, and of rows equal in all columns one stays. Loads may come in any
    order and more than once: the table is the same. The new buckets are written aside first, so a failure
    before the swap leaves the table as it was, and the load is applied again.
    """
    load = durable(with_bucket(load.filter(F.col(key).isNotNull()), key, buckets), "load")
    # At most as many as there are buckets.
    touched = sorted(r[0] for r in load.select(BUCKET).distinct().collect())
    if touched:
        kept = read_buckets(spark, path, table_schema(load.drop(BUCKET).schema, ts), touched)
        new = durable(merged(kept, load, key, ts), "new-buckets")
        one_each = new.repartition(F.col(BUCKET), F.pmod(F.xxhash64(key), F.lit(4)))
        one_each.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return touched
