"""SAM text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from germlight.functions.scalar import UNMAPPED, has_flag, mismatches_of, stripped
from germlight.sources.lines import numbered_lines

#: Fixed value: columns that every alignment line has.
MANDATORY = 11


def parse_sam(lines: DataFrame, column: str = "value") -> DataFrame:
    """Mapped alignments of lines; headers and short lines are left out.

    ordinal is the column of that name if lines have one, else the order in which Spark numbers the lines of its input partitions.
    """
    ordinal = F.col("ordinal") if "ordinal" in lines.columns else F.monotonically_increasing_id()
    # As a generated row, so that a line is split once: filters on the fields would take the split along with each use of it.
    part = lines.select(ordinal.alias("ordinal"), F.explode(F.array(F.split(stripped(F.col(column)), "\t"))).alias("f")).where((F.size("f") >= MANDATORY) & ~F.get("f", F.lit(0)).startswith("@"))
    tags = F.array_join(F.slice("f", MANDATORY + 1, F.greatest(F.size("f") - MANDATORY, F.lit(0))), "\t")
    f = lambda i, kind="string": F.get("f", F.lit(i)).cast(kind)
    return part.select(
        f(0).alias("read_id"), "ordinal", f(1, "int").alias("flag"), f(2).alias("reference_name"), (f(3, "int") - 1).alias("reference_start"), f(4, "int").alias("mapq"), f(5).alias("cigar"), f(9).alias("sequence"), f(10).alias("quality"),
        mismatches_of(tags).alias("mismatches"), tags.alias("tags"),
    ).where(~has_flag(F.col("flag"), UNMAPPED))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    return parse_sam(numbered_lines(spark, path))
