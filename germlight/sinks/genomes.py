"""Reference databases that any number of read sets share: combined FASTA, k-mer index, aligner's index, and the classifier's database."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from germlight.functions.scalar import fasta_text
from germlight.operators import chain, genomes, kmer, lca, minimizers
from germlight.sources.fasta import read_fasta


def combined(spark: SparkSession, *paths: str) -> DataFrame:
    """All sequences of several FASTA files or folders, gzip included."""
    return reduce(DataFrame.unionByName, (read_fasta(spark, p) for p in paths))


def host_free(sequences: DataFrame, paf: DataFrame, identity_threshold: float = 95.0) -> DataFrame:
    """Without the contigs that align to the host."""
    return genomes.without_contigs(sequences, genomes.host_like_contigs(paf, identity_threshold), "name")


def write_combined(sequences: DataFrame, path: str, mode: str = "errorifexists") -> None:
    sequences.select(fasta_text(F.col("header"), F.col("sequence"))).write.mode(mode).text(path)


def write_index(sequences: DataFrame, path: str, k: int = kmer.K, mode: str = "errorifexists") -> None:
    """The k-mer index as Parquet, ranged by k-mer so that readers skip row groups."""
    index = kmer.index(sequences.select(F.col("name").alias("reference"), "sequence"), k)
    index.repartitionByRange("kmer").sortWithinPartitions("kmer").write.mode(mode).parquet(path)


def write_aligner_index(sequences: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Seeds and bases for the chain aligner."""
    chain.write_index(chain.build_index(sequences.select(F.col("name").alias("reference"), "sequence")), path, mode)


def write_lca_database(sequences: DataFrame, taxids: DataFrame, taxonomy: DataFrame, path: str, k: int = minimizers.K, w: int = minimizers.W, mode: str = "errorifexists") -> None:
    """sequences(name, sequence), taxids(name, taxid) and taxonomy(taxid, parent, rank, name) as path/minimizers, ranged by minimizer, and path/nodes, with the paths from the root.

    Sequences without a node are left out."""
    paths = lca.root_paths(taxonomy)
    known = lca.database(sequences.join(taxids, "name").select("taxid", "sequence"), paths, k, w)
    names = taxonomy.groupBy("taxid").agg(F.min(F.struct("rank", "name")).alias("_n")).select("taxid", "_n.rank", "_n.name")
    paths.join(names, "taxid").withColumns({"k": F.lit(k), "w": F.lit(w)}).write.mode(mode).parquet(f"{path}/nodes")
    known.repartitionByRange("v").sortWithinPartitions("v").write.mode(mode).parquet(f"{path}/minimizers")


def read_lca_database(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, dict]:
    """Minimizers, nodes, and the settings that reads must be cut with."""
    nodes = spark.read.parquet(f"{path}/nodes")
    first = nodes.select("k", "w").first()
    return spark.read.parquet(f"{path}/minimizers"), nodes.drop("k", "w"), first.asDict() if first else {}
