"""Assembly summaries and PAF alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: 1-based columns of an assembly summary, names of PAF columns, genomes that a database takes.
SUMMARY_COLUMNS = {"version_status": 11, "assembly_level": 12, "ftp_path": 20}
PAF_COLUMNS = ("query_name", "query_length", "query_start", "query_end", "strand", "target_name", "target_length", "target_start", "target_end", "matches", "alignment_length", "mapq")
MAX_GENOMES = 1000


def read_assembly_summary(spark: SparkSession, path: str) -> DataFrame:
    fields = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.size(fields) >= max(SUMMARY_COLUMNS.values())))
    return lines.select(*(F.get(fields, F.lit(i - 1)).alias(c) for c, i in SUMMARY_COLUMNS.items()))


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    fields, text = F.split("value", "\t"), {"query_name", "strand", "target_name"}
    lines = spark.read.text(path).where(F.size(fields) >= len(PAF_COLUMNS))
    return lines.select(*(F.get(fields, F.lit(i)).cast("string" if c in text else "int").alias(c) for i, c in enumerate(PAF_COLUMNS)))
