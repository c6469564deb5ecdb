"""Host removal: by mapping quality, then by alignments to a host reference (left anti join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from germlight.functions.scalar import identity
from germlight.operators.dedup import last_wins


def host_primary(reads: DataFrame, mapq_threshold: int = 30) -> DataFrame:
    """Drops reads mapped at or above the threshold."""
    return reads.where(F.col("is_unmapped") | (F.col("mapq") < mapq_threshold))


def host_hits(alignments: DataFrame, identity_threshold: float = 95.0, min_aligned_length: int = 0) -> DataFrame:
    """(read_id, ordinal, identity, aligned_length, mismatches, gaps, is_host) of mapped alignment lines; the threshold is inclusive."""
    length = F.length("sequence")
    of = identity(length, F.col("mismatches"))
    return alignments.select(
        "read_id", "ordinal", of.alias("identity"), length.alias("aligned_length"), F.col("mismatches").cast("int").alias("mismatches"), F.lit(0).alias("gaps"), ((of >= identity_threshold) & (length >= min_aligned_length)).alias("is_host")
    )


def host_ids(hits: DataFrame, mode: str = "identity", order: tuple[str, ...] = ("ordinal",)) -> DataFrame:
    """Ids of reads that count as host."""
    if mode == "any_hit":
        return hits.select("read_id")
    if mode == "identity":
        return last_wins(hits.select("read_id", *order, "is_host"), "read_id", order).where("is_host").select("read_id")
    raise ValueError(f"unknown host mode {mode!r}")


def without_host(reads: DataFrame, hits: DataFrame, mode: str = "identity", order: tuple[str, ...] = ("ordinal",)) -> DataFrame:
    """Reads with no hit, or whose last hit isn't host; in mode any_hit, those with no hit at all. Reads that share an id all stay or go."""
    return reads.join(host_ids(hits, mode, order), "read_id", "left_anti")


def host_filtered(reads: DataFrame, hits: DataFrame | None, mapq_threshold: int = 30, mode: str = "identity") -> DataFrame:
    """Both filters; without hits the primary one alone."""
    first = host_primary(reads, mapq_threshold)
    return first if hits is None else without_host(first, hits, mode)


def host_stats(reads: DataFrame, hits: DataFrame | None, mapq_threshold: int = 30, mode: str = "identity") -> DataFrame:
    """One row: primary_filtered, secondary_filtered, passed."""
    first = F.col("is_unmapped") | (F.col("mapq") < mapq_threshold)
    rows = reads.select("read_id", F.coalesce(first, F.lit(False)).alias("first"))
    host = F.lit(False)
    if hits is not None:  # one pass over the reads, which meet at most one row each
        rows = rows.join(host_ids(hits, mode).distinct().withColumn("host", F.lit(True)), "read_id", "left")
        host = F.coalesce("host", F.lit(False))
    n = lambda condition, name: F.count_if(condition).alias(name)
    return rows.agg(n(~F.col("first"), "primary_filtered"), n(F.col("first") & host, "secondary_filtered"), n(F.col("first") & ~host, "passed"))
