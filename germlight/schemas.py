"""Canonical schemas. Counts stay in long form; a cell that is absent is zero."""

from pyspark.sql import types as T

READS = T.StructType(
    [
        T.StructField("read_id", T.StringType(), False),
        T.StructField("ordinal", T.LongType(), False),
        T.StructField("sequence", T.StringType()),
        T.StructField("quality", T.StringType()),
        T.StructField("barcode", T.StringType()),
        T.StructField("umi", T.StringType()),
        T.StructField("flag", T.IntegerType()),
        T.StructField("mapq", T.IntegerType()),
        T.StructField("is_unmapped", T.BooleanType()),
        T.StructField("is_secondary", T.BooleanType()),
        T.StructField("is_supplementary", T.BooleanType()),
        T.StructField("reference_name", T.StringType()),
        T.StructField("reference_start", T.IntegerType()),
        T.StructField("cigar", T.StringType()),
    ]
)
HOST_HITS = "read_id string, identity double, aligned_length int, mismatches int, gaps int, is_host boolean"
ASSIGNMENTS = "read_id string, taxid string, species string, genus string, confidence double, alignment_length int, num_kmers int, classified boolean"
FASTQ = "name string, sequence string, plus string, quality string"
COUNTS = "species string, barcode string, n long"
