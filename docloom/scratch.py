"""Tables written in a folder that the driver and all executors share, where lineage ends."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Whether shuffle files are deleted when the query that wrote them ends.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors and the driver see.

    Taken from ``spark.checkpoint.dir``. Only where that is unset and driver and executors are one process (tests) is a
    local folder made; on a cluster each executor would write to its own disk.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="docloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder, deleted when the session ends."""
    path = f"{shared_dir(spark)}/docloom/{label}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


#: Bytes after which an Arrow batch is sent to a Python worker. Spark's own is 64 MB, which both sides hold.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, most: int = 4 << 20) -> Iterator[None]:
    """What runs inside gets its Arrow batches in parts of about most bytes, at least a row."""
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, most)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


def written(df: DataFrame, label: str, options: dict | None = None) -> DataFrame:
    """Write df as a Parquet table in the shared folder, with options of the writer, and read it back.

    A lost executor costs only the tasks it was running. Shuffle files of the plan go once the table is written.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.options(**(options or {})).parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table made by written() that nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(file)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
