"""The library's surface in one place."""

from germlight.operators.chain import build_index, read_index
from germlight.operators.chain import align as chain_align
from germlight.operators.contamination import ambient_corrected, ambient_profile, ambient_scores, contamination_stats, decontaminated, doublets, microbes_per_cell, specificity_scores, species_masks
from germlight.operators.dedup import last_wins
from germlight.operators.genomes import complete_assemblies, genome_list, host_like_contigs, without_contigs
from germlight.operators.host import host_filtered, host_hits, host_primary, host_stats, without_host
from germlight.operators.kmer import align, vote
from germlight.operators.lca import classify, lowest_common_ancestors, profile, root_paths
from germlight.operators.matrix import cell_totals, coo, dense
from germlight.operators.qc import matrix_summary, qc_summary
from germlight.operators.quantify import cell_dim, quantification_stats, quantified, species_dim, valid_reads
from germlight.operators.reads import candidate_reads, chunks, coordinate_sorted, length_filtered, length_stats, parse_stats, primary_alignments, reads_by_barcode, unique_barcodes
from germlight.operators.taxonomy import aligner_stats, alignment_assignments, assign
from germlight.operators.umi import deduplicated, hamming_clusters
from germlight.options import Options, load_config
from germlight.pipeline import Result, analyse, read_bam, run, validate
from germlight.sinks.genomes import combined, host_free, read_lca_database, write_aligner_index, write_combined, write_index, write_lca_database
from germlight.sinks.matrix import write_h5ad, write_matrix, write_mtx, write_tsv
from germlight.sinks.report import qc_report, write_qc_report, write_stats, write_summary
from germlight.sinks.text import write_barcodes, write_cell_metadata, write_fasta, write_fastq, write_sorted_alignments
from germlight.sources import register
from germlight.sources.assembly import read_assembly_summary, read_paf
from germlight.sources.bai import index_totals
from germlight.sources.bai import write_index as write_bam_index
from germlight.sources.barcodes import read_bam_of
from germlight.sources.fasta import read_fasta
from germlight.sources.kraken import parse_kraken, read_kraken
from germlight.sources.sam import parse_sam, read_sam

__all__ = [name for name in dir() if not name.startswith("_")]
