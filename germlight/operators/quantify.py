"""Counts by species and cell, in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from germlight.functions.scalar import present
from germlight.functions.storage import checkpointed
from germlight.operators.umi import hamming_kept


def is_valid(method: str = "umi") -> Column:
    ok = F.coalesce(F.col("classified"), F.lit(False)) & present(F.col("barcode"))
    return ok & present(F.col("umi")) if method == "umi" else ok


def valid_reads(assigned: DataFrame, method: str = "umi") -> DataFrame:
    """Classified reads with a barcode and, for the umi method, a UMI; null and empty are alike."""
    return assigned.where(is_valid(method))


def quantified(assigned: DataFrame, method: str = "umi", dedup: str = "exact", threshold: int = 1) -> DataFrame:
    """counts(species, barcode, n): distinct molecules, or reads. Partial counts and distincts before the shuffle."""
    valid = valid_reads(assigned, method)
    if method == "reads":
        return valid.groupBy("species", "barcode").agg(F.count("*").alias("n"))
    if method != "umi":
        raise ValueError(f"unknown quantification method {method!r}")
    if dedup == "hamming":
        return hamming_kept(valid, threshold=threshold).groupBy("species", "barcode").agg(F.count("*").alias("n"))
    # Two steps with keys alone: the distinct codes of a frequent pair are spread over tasks.
    return valid.select("species", "barcode", "umi").distinct().groupBy("species", "barcode").agg(F.count("*").alias("n"))


def quantified_both(assigned: DataFrame) -> DataFrame:
    """(species, barcode, n_reads, n_umis) of the reads that count by the umi method, reads and distinct molecules from one scan."""
    molecules = valid_reads(assigned).groupBy("species", "barcode", "umi").agg(F.count("*").alias("_n"))
    return molecules.groupBy("species", "barcode").agg(F.sum("_n").alias("n_reads"), F.count("*").alias("n_umis"))


def quantification_stats(assigned: DataFrame, method: str = "umi") -> DataFrame:
    """One row of counters: unclassified reads leave first and uncounted, then those without a barcode, then those without a UMI."""
    known, barcode, umi = F.coalesce(F.col("classified"), F.lit(False)), present(F.col("barcode")), present(F.col("umi"))
    valid = is_valid(method)
    keys = F.struct("species", "barcode")
    return assigned.agg(
        F.count("*").alias("total_reads"),
        F.count_if(valid).alias("valid_reads"),
        F.count_if(known & ~barcode).alias("without_barcode"),
        F.count_if(known & barcode & ~umi if method == "umi" else F.lit(False)).alias("without_umi"),
        F.countDistinct(F.when(valid, keys)).alias("pairs"),
        F.count_if(valid).alias("total_umis"),
        F.countDistinct(F.when(valid, F.struct("species", "barcode", "umi"))).alias("deduplicated_umis"),
    )


def species_dim(counts: DataFrame) -> DataFrame:
    """species and its 0-based index in code-point order."""
    return indexed(counts.select("species").distinct(), "species", "species_idx")


def cell_dim(counts: DataFrame) -> DataFrame:
    """barcode and its 0-based index. Taken before contamination filtering: cells that lose all counts stay in the output."""
    return indexed(counts.select("barcode").distinct(), "barcode", "cell_idx")


def sizes_before(sizes: DataFrame) -> DataFrame:
    """(_p, _before): of partitions' sizes (_p, _n), the sum of those before each. One task sums them: a row a partition, whatever is in them."""
    return sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))


def indexed(keys: DataFrame, key: str, index: str) -> DataFrame:
    """Dense ranks without putting all keys in one task: range partitions are numbered within, and the sizes of those before are added.

    The sorted keys are written out, since a second sort could draw its ranges elsewhere and the numbers would not fit together.
    """
    part = keys.sort(key).select(key, F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i"))
    numbered = checkpointed(part.select(key, "_p", F.col("_i").bitwiseAND(F.lit((1 << 33) - 1)).alias("_k")))
    sizes = numbered.groupBy("_p").agg(F.count("*").alias("_n"))
    return numbered.join(F.broadcast(sizes_before(sizes)), "_p").select(key, (F.col("_before") + F.col("_k")).cast("int").alias(index))
