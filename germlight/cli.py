"""Command line: python -m germlight.cli --input reads.bam --output out --microbe-ref microbes.fa"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from germlight.options import CHOICES, Options, from_config, load_config

log = logging.getLogger("germlight")
LEVELS, LOG_NAME = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"), "germlight.log"


def parser() -> argparse.ArgumentParser:
    """Options that aren't given stay None, so that the configuration file, and then the defaults, fill them in."""
    p = argparse.ArgumentParser(prog="germlight", description="Find and count microbial reads in single-cell alignments.")
    p.add_argument("--input", "-i", required=True, help="BAM file or folder of BAM files")
    p.add_argument("--output", "-o", required=True, help="output folder")
    p.add_argument("--config", "-c", help="YAML file of options")
    p.add_argument("--host-ref", help="host reference FASTA; enables host removal by alignment")
    p.add_argument("--microbe-ref", "--minimap2-index", dest="microbe_ref", help="microbial reference FASTA, or an index of it: build_db's for the chain aligner, minimap2's for minimap2")
    p.add_argument("--kraken-db", help="database for kraken2, or build_db's for the lca aligner")
    p.add_argument("--aligner", choices=CHOICES["aligner"])
    p.add_argument("--barcode-tag")
    p.add_argument("--umi-tag")
    p.add_argument("--host-mapq", type=int)
    p.add_argument("--host-identity", type=float)
    p.add_argument("--host-mode", choices=CHOICES["host_mode"])
    p.add_argument("--min-microbe-mapq", type=int)
    p.add_argument("--quant-method", choices=CHOICES["quant_method"])
    p.add_argument("--umi-dedup-method", choices=CHOICES["umi_dedup_method"])
    p.add_argument("--contamination-method", choices=CHOICES["contamination_method"])
    p.add_argument("--ambient-cutoff", type=float, help="share of cells above which a species may be ambient")
    p.add_argument("--min-cells", type=int)
    p.add_argument("--specificity-threshold", type=float)
    p.add_argument("--skip-contamination-filter", action="store_true", default=None)
    p.add_argument("--formats", nargs="+")
    p.add_argument("--default-names", action="store_true", help="name species and cells by number")
    p.add_argument("--threads", "-t", type=int, default=4, help="local threads where no cluster is configured")
    p.add_argument("--chunk-size", type=int, default=10_000, help="accepted for old scripts; partitions take its place")
    p.add_argument("--log-level", default="INFO", type=str.upper, choices=LEVELS)
    p.add_argument("--log-file", help=f"file that the log also goes to; by default {LOG_NAME} in the output folder, if that is a local one")
    p.add_argument("--verbose", "-v", action="store_true", help="log at level DEBUG")
    return p


#: Arguments that aren't fields of Options.
OTHER = ("input", "output", "config", "host_ref", "microbe_ref", "kraken_db", "default_names", "threads", "chunk_size", "log_level", "log_file", "verbose")


def options_of(args: argparse.Namespace) -> Options:
    own = {k: v for k, v in vars(args).items() if k not in OTHER}
    return Options().updated(from_config(load_config(args.config))).updated(own)


def log_file(args: argparse.Namespace) -> str | None:
    if args.log_file or "://" in args.output:
        return args.log_file
    os.makedirs(args.output, exist_ok=True)
    return os.path.join(args.output, LOG_NAME)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    handlers: list[logging.Handler] = [logging.StreamHandler(sys.stdout), *([logging.FileHandler(path)] if (path := log_file(args)) else [])]
    logging.basicConfig(level="DEBUG" if args.verbose else args.log_level, handlers=handlers, format="%(asctime)s %(levelname)s %(message)s", force=True)
    from pyspark.sql import SparkSession

    from germlight.pipeline import run

    try:
        builder = SparkSession.builder.appName("germlight")
        spark = SparkSession.getActiveSession() or builder.config("spark.master", builder._options.get("spark.master", f"local[{args.threads}]")).getOrCreate()
        stats = run(spark, args.input, args.output, options_of(args), args.host_ref, args.microbe_ref, args.kraken_db, args.default_names)
        log.info("%s", stats)
        return 0
    except Exception:
        log.exception("the run failed")
        return 1


if __name__ == "__main__":
    sys.exit(main())
