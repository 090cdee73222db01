"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
FREED_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(
    cores: int | str = 8, name: str = "unmask", memory: str = "12g", scratch: str | None = None
) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the job brings its own.

    The scratch folder is the one the installation names. Only where it names none, this local
    session gets ``scratch`` or a temporary folder.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if scratch or SparkConf().get(CHECKPOINT_CONF) is None:
        builder = builder.config(CHECKPOINT_CONF, scratch or tempfile.mkdtemp(prefix="unmask-"))
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        raise ValueError(f"start the session with {CHECKPOINT_CONF} set to a folder that all executors share")
    return root.rstrip("/")


_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the scratch folder; ``release`` removes what was written there."""
    if not _made:
        atexit.register(_release_active)
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def scratch_made() -> list[str]:
    """Scratch paths of this process that were not removed yet."""
    return list(_made)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path, on whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    if path in _made:
        _made.remove(path)


def release(spark: SparkSession) -> None:
    """Delete every scratch table this process has made; results that read them end with it."""
    for path in list(_made):
        remove(spark, path)


def _release_active() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        release(spark)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when it is written, not when the driver happens to collect its garbage."""
    before = spark.conf.get(FREED_CONF, None)
    spark.conf.set(FREED_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED_CONF)
        else:
            spark.conf.set(FREED_CONF, before)


def durable(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write an intermediate result once to the shared folder and go on from the file.

    Used where a result feeds several later steps: a lost executor then costs a re-read,
    not a recomputation, and every reader sees the same rows.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def free(df: DataFrame) -> None:
    """Delete the scratch table that ``durable`` wrote for this frame; nothing may read it any more."""
    remove(df.sparkSession, df.scratch)


class Scratch:
    """Tables of one run that nothing needs once its result is written; they go when the run ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path, self._n = spark, scratch_path(spark, label), 0

    def table(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.path}/{self._n}"
        with shuffles_freed(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        remove(self.spark, self.path)


def spread_by(df: DataFrame, *columns: str) -> DataFrame:
    """Hash-partition by columns into the session's number of shuffle partitions.

    The number is given, so adaptive execution does not merge partitions whose rows are small
    now but grow in the steps that follow, such as texts about to be cut into n-grams.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)
