"""Per-read output of a k-mer classifier: state, read, taxid, length, and a lineage or list of k-mers, by TAB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from germlight.functions.scalar import lineage_rank, species_of, stripped
from germlight.sources.lines import numbered_lines

#: Fixed value: columns that every line has.
MANDATORY = 5


def parse_kraken(lines: DataFrame, mode: str = "lineage", column: str = "value") -> DataFrame:
    """Assignments of lines; short lines are left out.

    lineage: column 5 is a ;-separated lineage, whose last two names are genus and species. names: column 3 is `name (taxid N)`.
    """
    if mode not in ("lineage", "names"):
        raise ValueError(f"unknown classifier mode {mode!r}")
    ordinal = F.col("ordinal") if "ordinal" in lines.columns else F.monotonically_increasing_id()
    part = lines.select(ordinal.alias("ordinal"), F.split(stripped(F.col(column)), "\t").alias("f")).where(F.size("f") >= MANDATORY)
    f = lambda i: F.get("f", F.lit(i))
    known = f(0) == "C"
    if mode == "names":
        name = F.regexp_extract(f(2), r"^(.*?)\s*\(taxid \d+\)$", 1)
        taxid, species = F.regexp_extract(f(2), r"\(taxid (\d+)\)", 1), species_of(F.when(name != "", name).otherwise(f(2)))
        genus = F.element_at(F.split(species, " "), 1)
    else:
        taxid, species, genus = f(2), lineage_rank(f(4), 1), lineage_rank(f(4), 2)
    unknown = F.lit("unclassified")
    return part.select(
        f(1).alias("read_id"), "ordinal", taxid.alias("taxid"), F.when(known, species).otherwise(unknown).alias("species"), F.when(known, genus).otherwise(unknown).alias("genus"), F.when(known, 1.0).otherwise(0.0).alias("confidence"),
        f(3).try_cast("int").alias("alignment_length"), F.lit(None).cast("int").alias("num_kmers"), known.alias("classified"),
    )


def read_kraken(spark: SparkSession, path: str, mode: str = "lineage") -> DataFrame:
    return parse_kraken(numbered_lines(spark, path), mode)
