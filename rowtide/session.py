"""Session settings the library relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session options that results depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A JSON object that repeats a key keeps the last value instead of failing to parse.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # The JVM does not compile methods above 8,000 bytes of bytecode, so a larger generated stage would
    # be interpreted. Spark then falls back to one projection per operator, in small methods.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def local_session(cores: int | str = 8, app: str = "rowtide", memory: str | None = None) -> SparkSession:
    """A session for one machine; on a cluster use the one the launcher gives you."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory or os.environ.get("ROWTIDE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Recording the Python call site of every column expression doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder; it goes when the driver ends.

    Only where the session names no such folder and all tasks run in this process, as in tests, a temporary one is
    made and set. On a cluster a folder of this machine would not be shared, so there it is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="rowtide-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/rowtide-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def shelve(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there: the lineage ends, and a lost executor loses nothing."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


#: Pieces a slot into which a scan is dealt that fills the slots, but has no splits to spare.
PIECES = 4


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan with few splits out to tasks of equal length.

    Parsing and hashing envelopes is CPU-bound, so a small file read as one split would leave the other slots idle. A
    larger one has a split for each slot or more, but its row groups can't be cut: splits without one are empty, and
    others hold several. Its rows, of the columns that are read, are dealt out evenly, a few pieces a slot. A scan with
    many splits a slot evens out by itself and is returned as it is, with no shuffle.
    """
    slots, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if splits < slots:
        return df.repartition(slots)
    return df.repartition(PIECES * slots) if splits < PIECES * slots else df
