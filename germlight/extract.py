"""Extracts candidate reads: python -m germlight.extract -i reads.bam -o-fastq out -o-barcodes barcodes"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from germlight import pipeline
from germlight.operators import reads as read_ops
from germlight.options import Options
from germlight.sinks import text


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="germlight-extract", description="Write the reads of a BAM file that may not be host.")
    p.add_argument("-i", "--input", required=True)
    p.add_argument("-o-fastq", "--fastq", help="folder of FASTQ files")
    p.add_argument("-o-fasta", "--fasta", help="folder of FASTA files")
    p.add_argument("-o-barcodes", "--barcodes", help="folder with the distinct barcodes")
    p.add_argument("-barcode-tag", "--barcode-tag", default="CB")
    p.add_argument("-umi-tag", "--umi-tag", default="UB")
    p.add_argument("-mapq", "--mapq", type=int, default=30)
    p.add_argument("-no-unmapped", "--no-unmapped", action="store_true")
    p.add_argument("-no-low-mapq", "--no-low-mapq", action="store_true")
    p.add_argument("-compress", "--compress", action="store_true", help="gzip the FASTQ and FASTA files")
    p.add_argument("-threads", "--threads", type=int, default=0, help="local threads where no cluster is configured; 0: all")
    p.add_argument("-chunk-size", "--chunk-size", type=int, default=10_000, help="accepted for old scripts; partitions take its place")
    p.add_argument("-parallel", "--parallel", action="store_true", help="accepted for old scripts; reading is always parallel")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("germlight-extract").master(f"local[{args.threads or '*'}]").getOrCreate()
    own = pipeline.read_bam(spark, args.input, Options(barcode_tag=args.barcode_tag, umi_tag=args.umi_tag))
    choice = (args.mapq, not args.no_unmapped, not args.no_low_mapq)
    found = read_ops.candidate_reads(own, *choice)
    if args.fastq:
        text.write_fastq(found, args.fastq, args.compress)
    if args.fasta:
        text.write_fasta(found, args.fasta, args.compress)
    if args.barcodes:
        text.write_barcodes(found, args.barcodes)
    print(json.dumps(read_ops.parse_stats(own, *choice).first().asDict()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
