"""Builds a reference database from local files: python -m germlight.build_db --fasta a.fa b.fa.gz --host-paf hits.paf --output db

Summaries give the list of genomes to fetch (fetching is left to other tools); FASTA files become one combined set, without contigs that align to the host, a k-mer index, an index for
the chain aligner and, with a taxonomy, a database for the lca aligner.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from germlight.operators import genomes, kmer
from germlight.sinks import genomes as sink
from germlight.sources.assembly import MAX_GENOMES, read_assembly_summary, read_paf


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="germlight-build-db")
    p.add_argument("--output", "-o", required=True)
    p.add_argument("--summary", nargs="*", default=[], help="assembly summaries, in order of preference")
    p.add_argument("--fasta", nargs="*", default=[])
    p.add_argument("--host-paf", help="alignments of the genomes to the host")
    p.add_argument("--host-identity", type=float, default=95.0)
    p.add_argument("--max-genomes", type=int, default=MAX_GENOMES)
    p.add_argument("-k", type=int, default=kmer.K)
    p.add_argument("--taxonomy", help="nodes: taxid, parent, rank, name, by TAB")
    p.add_argument("--taxids", help="nodes of sequences: name, taxid, by TAB")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if not args.summary and not args.fasta:
        parser().error("nothing to build: give --summary or --fasta")
    if bool(args.taxonomy) != bool(args.taxids):
        parser().error("--taxonomy and --taxids go together")
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("germlight-build-db").getOrCreate()
    if args.summary:
        genomes.genome_list(*(read_assembly_summary(spark, s) for s in args.summary), limit=args.max_genomes).write.csv(os.path.join(args.output, "genomes"), sep="\t")
    if args.fasta:
        sequences = sink.combined(spark, *args.fasta)
        if args.host_paf:
            sequences = sink.host_free(sequences, read_paf(spark, args.host_paf), args.host_identity)
        sink.write_combined(sequences, os.path.join(args.output, "combined"))
        sink.write_index(sequences, os.path.join(args.output, "index"), args.k)
        sink.write_aligner_index(sequences, os.path.join(args.output, "aligner"))
        if args.taxonomy:
            nodes = spark.read.csv(args.taxonomy, sep="\t", schema="taxid long, parent long, rank string, name string")
            sink.write_lca_database(sequences, spark.read.csv(args.taxids, sep="\t", schema="name string, taxid long"), nodes, os.path.join(args.output, "lca"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
