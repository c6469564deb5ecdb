"""Read-level operators: candidate selection, counters, barcodes. All are narrow but for the distincts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from germlight.functions.scalar import barcode_of, present


def primary_alignments(reads: DataFrame) -> DataFrame:
    """Without secondary and supplementary records."""
    return reads.where(~F.col("is_secondary") & ~F.col("is_supplementary"))


def is_candidate(mapq_threshold: int = 30, include_unmapped: bool = True, include_low_mapq: bool = True):
    unmapped = F.col("is_unmapped")
    return (F.lit(include_unmapped) & unmapped) | (F.lit(include_low_mapq) & ~unmapped & (F.col("mapq") < mapq_threshold))


def candidate_reads(reads: DataFrame, mapq_threshold: int = 30, include_unmapped: bool = True, include_low_mapq: bool = True) -> DataFrame:
    """Primary records that may not be host: unmapped, or mapped below the threshold."""
    return primary_alignments(reads).where(is_candidate(mapq_threshold, include_unmapped, include_low_mapq))


def _parse_counters(mapq_threshold: int, include_unmapped: bool, include_low_mapq: bool) -> list:
    primary = ~F.col("is_secondary") & ~F.col("is_supplementary")
    n = lambda condition: F.count_if(condition)
    return [
        F.count(F.lit(1)).alias("total_reads"),
        n(primary & ~F.col("is_unmapped")).alias("mapped_reads"),
        n(primary & F.col("is_unmapped")).alias("unmapped_reads"),
        n(primary & ~F.col("is_unmapped") & (F.col("mapq") < mapq_threshold)).alias("low_mapq_reads"),
        n(primary & present(F.col("barcode"))).alias("reads_with_barcode"),
        n(primary & present(F.col("umi"))).alias("reads_with_umi"),
        n(primary & is_candidate(mapq_threshold, include_unmapped, include_low_mapq)).alias("candidate_reads"),
    ]


def parse_stats(reads: DataFrame, mapq_threshold: int = 30, include_unmapped: bool = True, include_low_mapq: bool = True) -> DataFrame:
    """One row of counters: total over all records, the others over primary ones."""
    return reads.agg(*_parse_counters(mapq_threshold, include_unmapped, include_low_mapq))


def observed_parse_stats(reads: DataFrame, observation: Observation, mapq_threshold: int = 30, include_unmapped: bool = True, include_low_mapq: bool = True) -> DataFrame:
    """reads unchanged, with the same counters gathered while they pass."""
    return reads.observe(observation, *_parse_counters(mapq_threshold, include_unmapped, include_low_mapq))


def unique_barcodes(reads: DataFrame) -> DataFrame:
    return reads.where(present(F.col("barcode"))).select("barcode").distinct()


def reads_by_barcode(reads: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Reads, secondary ones too, whose barcode is in the list; suffixes after a dash count on neither side."""
    wanted = barcodes.select(barcode_of(F.col("barcode")).alias("_b")).where(present(F.col("_b"))).distinct()
    return reads.join(wanted, barcode_of(F.col("barcode")) == F.col("_b"), "left_semi")


def chunks(reads: DataFrame, size: int = 10_000) -> DataFrame:
    """reads with a chunk number: `size` records each in the order of the reads, fewer in the last. Partitions are counted first, so that no task sees all rows."""
    from germlight.operators.quantify import sizes_before

    own = reads.withColumns({"_p": F.spark_partition_id(), "_k": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    before = sizes_before(own.groupBy("_p").agg(F.count("*").alias("_n")))
    return own.join(F.broadcast(before), "_p").withColumn("chunk", F.floor((F.col("_before") + F.col("_k")) / size)).drop("_p", "_k", "_before")


def length_filtered(fastq: DataFrame, min_length: int = 0, max_length: int = 0) -> DataFrame:
    """Records of min_length to max_length bases; a maximum of 0 is none."""
    n = F.length("sequence")
    return fastq.where((n >= min_length) & (n <= max_length) if max_length else n >= min_length)


def length_stats(fastq: DataFrame, min_length: int = 0, max_length: int = 0) -> DataFrame:
    """One row: records read, and those that length_filtered keeps."""
    n = F.length("sequence")
    kept = (n >= min_length) & (n <= max_length) if max_length else n >= min_length
    return fastq.agg(F.count("*").alias("processed"), F.count_if(kept).alias("written"))


def coordinate_sorted(alignments: DataFrame) -> DataFrame:
    return alignments.orderBy(F.col("reference_name").asc_nulls_last(), F.col("reference_start"), "read_id")
