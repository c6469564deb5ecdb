"""Taxonomy assignments from alignments or classifier output, and their join with the reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from germlight.functions.scalar import confidence, species_of
from germlight.operators.dedup import last_wins


def alignment_assignments(alignments: DataFrame, min_mapq: int = 1, min_confidence: float = 0.0, taxonomy: DataFrame | None = None) -> DataFrame:
    """One row for each alignment line of at least min_mapq. taxonomy, if given, has (species, taxid, genus)."""
    found = alignments.where(F.col("mapq") >= min_mapq).select(
        "read_id", "ordinal", species_of(F.col("reference_name")).alias("species"), confidence(F.col("mapq")).alias("confidence"), F.length("sequence").alias("alignment_length"), F.lit(None).cast("int").alias("num_kmers"), F.lit(True).alias("classified")
    ).where(F.col("confidence") >= min_confidence)
    if taxonomy is None:
        found = found.withColumns({"taxid": F.lit("unknown"), "genus": F.lit("unknown")})
    else:
        found = found.join(taxonomy.select("species", "taxid", "genus"), "species", "left").fillna("unknown", ["taxid", "genus"])
    return found.select("read_id", "ordinal", "taxid", "species", "genus", "confidence", "alignment_length", "num_kmers", "classified")


def assign(reads: DataFrame, assignments: DataFrame, reads_order: tuple[str, ...] = ("ordinal",), order: tuple[str, ...] = ("ordinal",)) -> DataFrame:
    """Inner join on read_id; on either side the last row of an id counts."""
    own = last_wins(reads, "read_id", reads_order)
    theirs = last_wins(assignments, "read_id", order).drop(*order)
    return own.join(theirs, "read_id")


def aligner_stats(assigned: DataFrame) -> DataFrame:
    """One row: total, classified, unclassified, unique_species."""
    known = F.col("classified")
    return assigned.agg(F.count("*").alias("total_reads"), F.count_if(known).alias("classified_reads"), F.count_if(~known).alias("unclassified_reads"), F.countDistinct(F.when(known, F.col("species"))).alias("unique_species"))
