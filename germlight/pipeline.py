"""The whole analysis as one lazy chain: scan, candidates, host removal, taxonomy, counts, contamination, sinks."""

from __future__ import annotations

import logging
import os
import shutil
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from germlight import sources
from germlight.functions.storage import delete, materialised
from germlight.operators import chain, contamination, external, host, kmer, lca, quantify, reads as read_ops, taxonomy
from germlight.options import Options
from germlight.sinks import matrix as matrix_sink
from germlight.sinks import report
from germlight.sinks.genomes import read_lca_database
from germlight.sources.fasta import read_fasta
from germlight.sources.kraken import parse_kraken
from germlight.sources.sam import parse_sam

log = logging.getLogger("germlight")


@dataclass
class Result:
    """Lazy tables of a run."""

    reads: DataFrame
    candidates: DataFrame
    without_host: DataFrame
    assigned: DataFrame
    raw_counts: DataFrame
    counts: DataFrame
    masks: DataFrame | None

    @property
    def cells(self) -> DataFrame:
        """Numbered cells of the unfiltered counts; asking for them computes the counts."""
        return quantify.cell_dim(self.raw_counts)


def validate(options: Options, input_path: str, microbe_ref: str | None, kraken_db: str | None) -> None:
    """Raises ValueError for what would fail later."""
    if "://" not in input_path and not os.path.exists(input_path):
        raise ValueError(f"input {input_path} doesn't exist")
    if options.aligner == "kraken2" and not kraken_db:
        raise ValueError("the kraken2 aligner needs a database")
    if options.aligner == "lca" and not kraken_db:
        raise ValueError("the lca aligner needs a database, as build_db writes it")
    if options.aligner not in ("kraken2", "lca") and not microbe_ref:
        raise ValueError(f"the {options.aligner} aligner needs a microbial reference")
    if options.aligner in ("minimap2", "kraken2") and shutil.which(options.aligner) is None:
        raise ValueError(f"{options.aligner} is not on the PATH; the kmer aligner needs no program")


def read_bam(spark: SparkSession, path: str, options: Options) -> DataFrame:
    sources.register(spark)
    return spark.read.format("bam").option("barcode_tag", options.barcode_tag).option("umi_tag", options.umi_tag).load(path)


def _references(spark: SparkSession, path: str) -> DataFrame:
    return read_fasta(spark, path).select(F.col("name").alias("reference"), "sequence")


def columns_used(options: Options) -> tuple[str, ...]:
    """What the steps after the candidates read of them."""
    return ("read_id", "ordinal", "sequence", "barcode", "umi", "mapq", "is_unmapped", *(("quality",) if options.aligner in ("minimap2", "bowtie2", "kraken2") else ()))


def alignments(spark: SparkSession, reads: DataFrame, reference: str, options: Options, stored: bool = False) -> DataFrame:
    """Alignment lines of reads to a FASTA reference or, for the chain aligner, to an index of one: natively, or by the external program. stored: reads may be scanned to count their sequences."""
    if options.aligner in ("minimap2", "bowtie2"):
        if options.aligner == "bowtie2":
            log.warning("bowtie2 isn't driven; minimap2 takes its place")
        return parse_sam(external.lines_of(reads, external.minimap2_command(reference)))
    if options.aligner in ("chain", "lca"):
        return chain.align(reads, chain.read_index(spark, reference) or chain.build_index(_references(spark, reference)), few=stored and chain.of_few_sequences(reads))
    return kmer.align(reads, _references(spark, reference))


def clean_reads(spark: SparkSession, candidates: DataFrame, options: Options, host_ref: str | None, stored: bool = False) -> DataFrame:
    """Candidates that are not host."""
    hits = None
    if host_ref:
        hits = host.host_hits(alignments(spark, host.host_primary(candidates, options.host_mapq), host_ref, options, stored), options.host_identity, options.host_min_aligned)
    return host.host_filtered(candidates, hits, options.host_mapq, options.host_mode)


def assigned_reads(spark: SparkSession, clean: DataFrame, options: Options, microbe_ref: str | None, kraken_db: str | None, stored: bool = False) -> DataFrame:
    if options.aligner == "kraken2":
        found = parse_kraken(external.lines_of(clean, external.kraken2_command(kraken_db)), options.kraken_mode)
    elif options.aligner == "lca":
        known, nodes, settings = read_lca_database(spark, kraken_db)
        own = clean.select("read_id", "ordinal", F.upper("sequence").alias("sequence"))
        calls = lca.classify(own, known, nodes, "read_id", "ordinal", confidence=options.min_confidence, **settings)
        found = lca.assignments(own, calls, nodes, nodes)
    else:
        found = taxonomy.alignment_assignments(alignments(spark, clean, microbe_ref, options, stored), options.min_microbe_mapq, options.min_confidence)
    if stored:  # what counts need; the last row of an id is chosen with all its columns
        clean, found = clean.select("read_id", "ordinal", "barcode", "umi"), found.select("read_id", "ordinal", "species", "classified")
    return taxonomy.assign(clean, found)


def _masks(raw: DataFrame, options: Options) -> DataFrame | None:
    if options.skip_contamination_filter:
        return None
    return contamination.species_masks(raw, options.contamination_method, options.ambient_cutoff, options.min_reads_per_cell, options.min_cells, options.specificity_threshold)


def analyse(spark: SparkSession, reads: DataFrame, options: Options, host_ref: str | None = None, microbe_ref: str | None = None, kraken_db: str | None = None) -> Result:
    """The whole chain, nothing of it computed yet."""
    candidates = read_ops.candidate_reads(reads, options.host_mapq, options.include_unmapped, options.include_low_mapq)
    clean = clean_reads(spark, candidates, options, host_ref)
    assigned = assigned_reads(spark, clean, options, microbe_ref, kraken_db)
    raw = quantify.quantified(assigned, options.quant_method, options.umi_dedup_method, options.umi_threshold)
    masks = _masks(raw, options)
    return Result(reads, candidates, clean, assigned, raw, raw if masks is None else contamination.decontaminated(raw, masks), masks)


def run(spark: SparkSession, input_path: str, output: str, options: Options | None = None, host_ref: str | None = None, microbe_ref: str | None = None, kraken_db: str | None = None, default_names: bool = False) -> dict:
    """Runs the analysis and writes matrices, statistics and the quality report; returns the statistics.

    The input is decoded once: candidates, reads without host and assignments are written to the shared folder as they are made, each with the columns that later
    steps read, and deleted as soon as the next ones are there.
    """
    options = options or Options()
    validate(options, input_path, microbe_ref, kraken_db)
    paths: list[str] = []

    def kept(df: DataFrame, label: str) -> DataFrame:
        found, path = materialised(df, label)
        paths.append(path)
        return found

    choice, seen = (options.host_mapq, options.include_unmapped, options.include_low_mapq), Observation()
    try:
        reads = read_ops.observed_parse_stats(read_bam(spark, input_path, options), seen, *choice)
        clean = candidates = kept(read_ops.candidate_reads(reads, *choice).select(*columns_used(options)), "candidates")
        if host_ref:
            clean = kept(clean_reads(spark, candidates, options, host_ref, True), "clean")
            delete(spark, paths.pop(0))
        assigned = kept(assigned_reads(spark, clean, options, microbe_ref, kraken_db, True).select("barcode", "umi", "species", "classified"), "assigned")
        n_clean = clean.count()
        delete(spark, paths.pop(0))
        raw = kept(quantify.quantified(assigned, options.quant_method, options.umi_dedup_method, options.umi_threshold), "counts")
        masks, cells, parsed = _masks(raw, options), quantify.cell_dim(raw), seen.get
        counts = raw if masks is None else contamination.decontaminated(raw, masks)
        species = quantify.species_dim(counts)
        os.makedirs(output, exist_ok=True)
        matrix_sink.write_matrix(counts, output, options.formats, species, cells, default_names=default_names)
        stats = {
            "total_reads": parsed["candidate_reads"],
            "host_filtered": n_clean,
            "microbial_aligned": assigned.where("classified").count(),
            "final_matrix_shape": (species.count(), cells.count()),
            "bam_total_reads": parsed["total_reads"],
            "parse": parsed,
            "quantification": quantify.quantification_stats(assigned, options.quant_method).first().asDict(),
        }
        if masks is not None:
            stats["contamination"] = contamination.contamination_stats(masks).first().asDict()
        report.write_stats(stats, os.path.join(output, "germlight_stats.json"))
        report.write_qc_report(counts, species, cells, os.path.join(output, "qc_report.txt"))
        report.write_summary(output)
        return stats
    finally:
        for path in paths:
            delete(spark, path)
