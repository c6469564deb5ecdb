"""Materialised intermediates on storage that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of its own only where that setting is missing, as in local tests."""
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root is None and spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(root or tempfile.mkdtemp(prefix="germlight-"))
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
    return current.get()


def passing_folder(spark: SparkSession, label: str) -> str:
    """A new folder's path in the shared one; what is written there is deleted when the application ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(where)
    store.deleteOnExit(where)
    return f"{path}/data"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def freed_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of queries that run inside are deleted as each one ends. Otherwise they lie there until the driver's garbage collector finds their plans unused."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


#: Bytes of stored steps that a task reads at most. They take some 20 bytes a row, so that Spark's default of 128 MB would be millions of rows, which sorts of a task spill.
STEP = 16 << 20


def step_by_step(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries that run inside read files by STEP bytes a task, or by fewer where that is set."""
    name = "spark.sql.files.maxPartitionBytes"
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    return _setting(spark, name, str(min(size, STEP)))


def materialised(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """df as Parquet in the shared folder, read back: columnar, so that later uses read the columns they need; and its path, for delete(). What is left is deleted when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with freed_shuffles(spark), step_by_step(spark):
        df.write.parquet(path, compression="zstd")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.parquet(path), path


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """df computed once into the shared folder, so that later uses read it and a lost executor costs no rescan."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
