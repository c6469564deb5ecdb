"""Keeps counts of molecules by species and cell up to date while files of reads arrive.

    python -m jobs.molecule_counts --reads reads/ --orders orders.parquet --parts part.parquet --output out --checkpoint state --config jobs/molecule_counts.json

Each run takes the files of reads that came since the last one (a file stream with its checkpoint, run until nothing is left) and no others. Of candidate reads that
are classified and have barcode and UMI, the stream's state lets each (species, cell, UMI) through once, ever; its state is as large as there are molecules,
so it is kept by RocksDB, spread by the whole key. Under output:

    deltas/batch=B/shelf=S     species, barcode, n: molecules that batch B saw first. A batch that runs again after a failure replaces its own partitions.
    counts/shelf=S             species, barcode, n, upto: the sum of deltas. Only shelves with deltas of batches after their `upto` are written anew.
    species/upto=B             species and the contamination rules' verdicts over all counts up to batch B.

A run that breaks off leaves a state from which the next one goes on: the checkpoint names the batch to run again, and shelves or verdicts that are behind the
deltas are found by their batch numbers. A shelf is a hash of the barcode, so that readers of some cells read few files.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from germlight.operators.contamination import species_masks
from germlight.operators.quantify import valid_reads
from germlight.operators.reads import candidate_reads
from germlight.plans.proxy import as_reads
from jobs.common import as_pattern, command_line, load_config, log, replacing, settings, written

DEFAULTS = {"mapq": 30, "shelves": 16, "files_per_trigger": 100, "ambient_cutoff": 0.1, "specificity_threshold": 2.0}
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
DELTAS = "species string, barcode string, n long, batch long, shelf int"
COUNTS = "species string, barcode string, n long, upto long, shelf int"
SPECIES = "species string, keep_ambient boolean, keep_specificity boolean, keep boolean, upto long"


def molecules(rows: DataFrame, orders: DataFrame, parts: DataFrame, mapq: int) -> DataFrame:
    """(species, barcode, umi) of the valid candidates among order lines, repeats and all."""
    reads = as_reads(rows, orders, parts).drop("barcode", "umi").withColumnsRenamed({"tagged_barcode": "barcode", "tagged_umi": "umi"})
    return valid_reads(candidate_reads(reads, mapq)).select("species", "barcode", "umi")


def _take_new(spark: SparkSession, reads: str, orders: str, parts: str, output: str, checkpoint: str, config: Mapping[str, Any]) -> None:
    stream = spark.readStream.schema(spark.read.parquet(reads).schema).option("maxFilesPerTrigger", config["files_per_trigger"]).parquet(as_pattern(reads))
    first_seen = molecules(stream, spark.read.parquet(orders), spark.read.parquet(parts), config["mapq"]).dropDuplicates(["species", "barcode", "umi"])

    def add(batch: DataFrame, number: int) -> None:
        delta = batch.groupBy("species", "barcode").agg(F.count("*").alias("n"))
        shelf = F.pmod(F.crc32(F.col("barcode").cast("binary")), F.lit(config["shelves"])).cast("int")
        replacing(delta.withColumns({"batch": F.lit(number).cast("long"), "shelf": shelf}), "batch", "shelf").parquet(f"{output}/deltas")

    with settings(spark, STATE):
        query = first_seen.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        finally:
            query.stop()
    for p in query.recentProgress:
        log.info("read %s rows of reads in batch %s", p["numInputRows"], p["batchId"])


def _sum_up(spark: SparkSession, output: str) -> None:
    """Shelves that are behind their deltas, which are known from the folders' names and one short row a shelf."""
    deltas, counts = written(spark, f"{output}/deltas", DELTAS), written(spark, f"{output}/counts", COUNTS)
    last = deltas.groupBy("shelf").agg(F.max("batch").alias("upto"))
    behind = last.join(counts.groupBy("shelf").agg(F.max("upto").alias("had")), "shelf", "left").where(F.coalesce("had", F.lit(-1)) < F.col("upto")).select("shelf", "upto").collect()
    if behind:
        of_shelf = F.broadcast(spark.createDataFrame(behind, "shelf int, upto long"))
        own = deltas.where(F.col("shelf").isin([r["shelf"] for r in behind])).groupBy("shelf", "species", "barcode").agg(F.sum("n").alias("n"))
        replacing(own.join(of_shelf, "shelf").select("species", "barcode", "n", "upto", "shelf"), "shelf").parquet(f"{output}/counts")
    log.info("wrote counts of %s shelves", len(behind))


def _judge(spark: SparkSession, output: str, config: Mapping[str, Any]) -> None:
    """Verdicts over all counts, where there are none yet for the last batch."""
    counts = written(spark, f"{output}/counts", COUNTS)
    upto = counts.agg(F.max("upto")).first()[0]
    if upto is None or not written(spark, f"{output}/species", SPECIES).where(F.col("upto") == upto).isEmpty():
        log.info("no new verdicts")
        return
    masks = species_masks(counts, "ambient", config["ambient_cutoff"], specificity_threshold=config["specificity_threshold"])
    replacing(masks.select("species", "keep_ambient", "keep_specificity", "keep", F.lit(upto).alias("upto")), "upto").parquet(f"{output}/species")
    log.info("wrote verdicts up to batch %s", upto)


def result(spark: SparkSession, output: str) -> DataFrame:
    """species, barcode, n and keep, as they stand."""
    verdicts = written(spark, f"{output}/species", SPECIES)
    latest = verdicts.join(F.broadcast(verdicts.agg(F.max("upto").alias("_last"))), F.col("upto") == F.col("_last")).select("species", "keep")
    return written(spark, f"{output}/counts", COUNTS).join(latest, "species").select("species", "barcode", "n", "keep")


def run(spark: SparkSession, reads: str, orders: str, parts: str, output: str, checkpoint: str, config: Mapping[str, Any] | None = None) -> DataFrame:
    """Takes what is new and brings the output up to date; running it again changes nothing. Returns result()."""
    config = {**DEFAULTS, **(config or {})}
    _take_new(spark, reads, orders, parts, output, checkpoint, config)
    _sum_up(spark, output)
    _judge(spark, output, config)
    return result(spark, output)


if __name__ == "__main__":
    session, args = command_line("jobs.molecule_counts", __doc__.splitlines()[0], "reads", "orders", "parts", "output", "checkpoint")
    try:
        run(session, args.reads, args.orders, args.parts, args.output, args.checkpoint, load_config(session, args.config, DEFAULTS))
    finally:
        session.stop()
