"""Read-level operators over a stream of read files: the batch operators are stateless, so they serve as they are, with static references beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from germlight.operators import host, reads as read_ops
from germlight.operators.dedup import last_wins
from germlight.schemas import READS


def read_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files of reads as they arrive in a folder."""
    return spark.readStream.schema(READS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def candidates(stream: DataFrame, mapq_threshold: int = 30) -> DataFrame:
    return read_ops.candidate_reads(stream, mapq_threshold)


def without_host(stream: DataFrame, hits: DataFrame, mode: str = "identity") -> DataFrame:
    """hits is static: it is joined anew in each micro-batch."""
    return host.without_host(stream, hits, mode)


def assigned(stream: DataFrame, assignments: DataFrame) -> DataFrame:
    """Inner join with static assignments. A read id that repeats in the stream keeps all its rows: the last one isn't known before the stream ends."""
    theirs = last_wins(assignments, "read_id").drop("ordinal")
    return stream.join(theirs, "read_id")


def to_parquet(stream: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Exactly-once output; start() it. The checkpoint belongs on shared storage."""
    return stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append")
