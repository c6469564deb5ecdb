"""FASTA: one row a sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """name (first word of the header), header, sequence (upper case, line ends removed) and file; gzip by suffix. Records are split at lines that start with `>`, so a file is read in parallel."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", r"^\s*>", "").alias("value")).where(F.trim(F.regexp_replace("value", r"\s+", "")) != "")
    header = F.regexp_replace(F.substring_index("value", "\n", 1), "\r$", "")
    body = F.expr("substring(value, instr(concat(value, '\n'), '\n') + 1)")
    return rows.select(F.element_at(F.split(F.trim(header), r"\s+"), 1).alias("name"), header.alias("header"), F.upper(F.regexp_replace(body, r"\s+", "")).alias("sequence"), F.input_file_name().alias("file"))
