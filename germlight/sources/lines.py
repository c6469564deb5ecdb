"""Lines of text with their order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """value and ordinal: file, start of the split and number in it. Spark deals splits out by size, so that the number alone would not follow the files' order."""
    return spark.read.text(path).select("value", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line")).alias("ordinal"))
