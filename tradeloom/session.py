"""Session settings shared by tests, the bench and the batch run."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split into several tasks even where that costs a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join one of whose sides comes in small parts looks up their rows and sorts neither side.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # A stage whose rules and parsers make a method that the JVM would only interpret runs in smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# What ``scratch`` sets while it lasts.
SCRATCH_SETTINGS = {
    # The shuffle files of a statement go when it ends, not when the driver's garbage is collected.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # A task that writes a few folders keeps their files open instead of sorting its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

#: Write options of Parquet files that are smaller than by default for little more time.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session; on a cluster the caller brings its own and uses ``configure``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tradeloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Do not record a Python call site for every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in RUNTIME_SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (shuffle sizing stays the owner's)."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession, local_default: str | None = None) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    ``local_default`` is only used on a local master, where one machine is all there is.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if local_default and spark.sparkContext.master.startswith("local"):
        return local_default
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def work_dir(spark: SparkSession) -> str:
    """A new folder's path in the shared folder; what is put there goes when the driver's JVM ends."""
    folder = f"{shared_dir(spark, 'spark-warehouse/shared').rstrip('/')}/tradeloom-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def cut_lineage(df: DataFrame, name: str = "rows") -> DataFrame:
    """Write a frame that several branches read to the shared folder, once, as Parquet.

    Lost executors cost a re-read, not a recomputation, and each branch reads
    only its columns.  The files go when the driver's JVM ends.
    """
    folder = work_dir(df.sparkSession)
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A step whose files last no longer than they are read.

    Gives a ``cut_lineage`` whose files go when the block ends; the shuffle files
    of each statement in the block go when that ends.  No frame that outlives the
    block may read what was written there.
    """
    folder, before = work_dir(spark), {name: spark.conf.get(name) for name in SCRATCH_SETTINGS}

    def write(df: DataFrame, name: str) -> DataFrame:
        df.write.options(**PACKED).parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    for name, value in SCRATCH_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield write
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
