"""FASTQ, FASTA and barcode lists, written in parallel as folders of part files; on request as gzip, or FASTQ as gzip blocks that can be read in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from germlight.functions.scalar import fasta_text, fastq_text
from germlight.operators.reads import unique_barcodes
from germlight.sinks.bam import values_of, write_blocks


def _write(lines: DataFrame, path: str, compress: bool, mode: str) -> None:
    writer = lines.write.mode(mode)
    (writer.option("compression", "gzip") if compress else writer).text(path)


def write_fastq(reads: DataFrame, path: str, compress: bool = False, name: str = "read_id", mode: str = "errorifexists") -> None:
    _write(reads.select(fastq_text(F.col(name), F.col("sequence"), F.col("quality"))), path, compress, mode)


def write_fastq_blocks(reads: DataFrame, path: str, name: str = "read_id") -> list[str]:
    """A folder of .fastq.gz files of gzip blocks, a file a partition; the files' names, in order."""

    def encode(batch) -> bytes:
        if batch.column(0).null_count:
            raise ValueError("a read without a name")
        return values_of(batch.column(0))[1].tobytes()

    return write_blocks(reads.select(F.concat(fastq_text(F.col(name), F.col("sequence"), F.col("quality")), F.lit("\n"))), path, ".fastq.gz", b"", encode)


def write_fasta(reads: DataFrame, path: str, compress: bool = False, name: str = "read_id", mode: str = "errorifexists") -> None:
    _write(reads.select(fasta_text(F.col(name), F.col("sequence"))), path, compress, mode)


def write_barcodes(reads: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Distinct, non-empty, sorted."""
    unique_barcodes(reads).sort("barcode").write.mode(mode).csv(path, sep="\t")


def write_cell_metadata(metadata: DataFrame, path: str, mode: str = "errorifexists") -> None:
    metadata.write.mode(mode).csv(path, sep="\t", header=True)


def write_sorted_alignments(alignments: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Alignments in coordinate order as Parquet, range-partitioned, so readers prune by reference and place."""
    from germlight.operators.reads import coordinate_sorted

    coordinate_sorted(alignments).write.mode(mode).parquet(path)
