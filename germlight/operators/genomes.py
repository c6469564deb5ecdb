"""Reference genomes: choosing assemblies, dropping host-like contigs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from germlight.functions.scalar import basename

#: What an assembly must be.
LEVEL, STATUS = "Complete Genome", "latest"


def complete_assemblies(summary: DataFrame) -> DataFrame:
    """url and accession of complete, latest assemblies of a summary with columns version_status, assembly_level and ftp_path."""
    return summary.where((F.col("assembly_level") == LEVEL) & (F.col("version_status") == STATUS)).select(F.col("ftp_path").alias("url"), basename(F.col("ftp_path")).alias("accession"))


def genome_list(*summaries: DataFrame, limit: int = 1000) -> DataFrame:
    """The first `limit` genomes of the summaries in their order, then by url."""
    ranked = [complete_assemblies(s).withColumn("_rank", F.lit(i)) for i, s in enumerate(summaries)]
    return reduce(DataFrame.unionByName, ranked).orderBy("_rank", "url").limit(limit).drop("_rank")


def host_like_contigs(paf: DataFrame, identity_threshold: float = 95.0) -> DataFrame:
    """Sorted distinct contigs with an alignment of at least that identity: matches over alignment length."""
    same = F.when(F.col("alignment_length") > 0, F.col("matches") / F.col("alignment_length") * 100)
    return paf.where(same >= identity_threshold).select(F.col("query_name").alias("contig")).distinct().orderBy("contig")


def without_contigs(genomes: DataFrame, contigs: DataFrame, key: str = "contig") -> DataFrame:
    return genomes.join(contigs.select(F.col("contig").alias(key)), key, "left_anti")
