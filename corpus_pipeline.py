"""A training-corpus pipeline over the documents table: each stage calls one operator of germlight.llm and works on all that the one before it kept.

Stages in order: quality rules and the quality classifier drop what they reject, near-duplicate groups keep one document each, contaminated documents are
dropped, and the rest is encoded. The classifier learns from all labelled documents of the source table that aren't held out, whatever the rules drop.
Every stage but the last returns the columns of its input. Between stages the rows are Parquet in the shared folder.

Defined cases: null and empty texts fail the quality rules; an empty table stays empty; rows that repeat id and text are one document in the near-duplicate
stage; other columns, whatever they are called, pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from germlight.llm import decontaminate, prefix_bpe, quality_classifier, quality_rules, simhash
from germlight.llm._shared import Scratch, bounded_broadcast, fresh_dir, table

#: Ids up to which a list of dropped documents is broadcast.
BROADCAST_IDS = 500_000
#: SQL can't express the classifier, the fingerprints or the encoding; tests/llm hold a brute-force version.
ORACLE_SQL = None


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs, quality_rules.STANDARD)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stats = quality_classifier.document_statistics(F.col("text"))
    # From the source table: few or no low-quality documents are left among docs, and one class alone teaches nothing.
    source = table(spark, sf_dir, "documents").select("doc_id", stats.alias("stats"))
    model = quality_classifier.fit(source, table(spark, sf_dir, "labels"))
    return docs.where(quality_classifier.score(stats, model) >= quality_classifier.THRESHOLD)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(docs, similar=True)
    return _without(docs, groups.groupBy("doc_id", "text_hash").agg(F.bool_and("representative").alias("keep"), F.count("*").alias("copies")), Scratch(spark, "winners"))


def _without(docs: DataFrame, decided: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of docs whose id and text are to be kept, one of each. Only decisions that change something meet the texts, in one join."""
    todo = scratch.keep(decided.where(~F.col("keep") | (F.col("copies") > 1)).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "keep"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_own"), F.xxhash64("text").alias("_text"))
    rows = rows.join(bounded_broadcast(todo, BROADCAST_IDS), F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left")
    once = rows.where("keep IS NULL").select("_row.*")
    if todo.where("keep").isEmpty():
        return once
    again = rows.where("keep").withColumn("_n", F.row_number().over(Window.partitionBy("_own", "_text").orderBy("_text"))).where("_n = 1")
    return once.unionByName(again.select("_row.*"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    hit = Scratch(spark, "hit").keep(found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct())
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_own"), F.xxhash64("text").alias("_text"))
    # By id and text: another document may have the same id, or none either.
    return rows.join(bounded_broadcast(hit, BROADCAST_IDS), F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left_anti").select("_row.*")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    # Workers outlive a stage for a while, beside those of the next: small memos here.
    return prefix_bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, memo=prefix_bpe.SMALL_MEMO)


STAGES = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), fresh_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
