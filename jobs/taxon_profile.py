"""Which panel sequences do the records of each source hold, and how sure is that? A taxonomic profile of every source.

    python -m jobs.taxon_profile --documents documents.parquet --panel benchmark.parquet --output out --config jobs/taxon_profile.json

Panel sequences stand in a tree; a minimizer that several of them share belongs to their lowest common ancestor. Every whole record is classified by its
minimizers and counted at its node and at those above it. Under output:

    panel/minimizers, panel/nodes    the database: minimizers with their nodes, nodes with their paths from the root
    calls/source=S                   doc_id, taxid, n_minimizers, n_hits, score, support of every record
    profile/source=S                 taxid, n_reads, n_clade, share of the source's records in the clade; taxid null: unclassified

Each write replaces the partitions that it has rows for, so a second run over the same input leaves the same rows, and a run over more sources
adds theirs. A source of most records is written and counted by many tasks. A null source is one of its own, of empty name.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from germlight.operators import lca
from germlight.operators.minimizers import alphabetic
from germlight.plans.catalog import item_taxonomy
from germlight.plans.proxy import spread
from jobs.common import command_line, load_config, log, replacing, written

DEFAULTS = {"k": 16, "w": 6, "confidence": 0.01}
CALLS = "doc_id long, taxid long, n_minimizers long, n_hits long, score long, support long, source string"
PROFILE = "taxid long, n_reads long, n_clade long, share double, source string"


def build_panel(spark: SparkSession, panel: str, output: str, config: Mapping[str, Any]) -> tuple[DataFrame, DataFrame]:
    """(minimizers, nodes), written and read back."""
    nodes, items = item_taxonomy(spark.read.parquet(panel).select("item_id", "text"))
    paths = lca.root_paths(nodes)
    known = lca.database(items.select("taxid", F.col("text").alias("sequence")), paths, config["k"], config["w"], alphabetic)
    paths.write.mode("overwrite").parquet(f"{output}/panel/nodes")
    known.write.mode("overwrite").parquet(f"{output}/panel/minimizers")
    back = spark.read.parquet(f"{output}/panel/minimizers"), spark.read.parquet(f"{output}/panel/nodes")
    log.info("wrote a panel of %s minimizers and %s nodes", *(x.count() for x in back))
    return back


def run(spark: SparkSession, documents: str, panel: str, output: str, config: Mapping[str, Any] | None = None) -> DataFrame:
    """Classifies all records and writes calls and profile; returns the profile as it stands."""
    config = {**DEFAULTS, **(config or {})}
    known, nodes = build_panel(spark, panel, output, config)
    docs = spread(spark.read.parquet(documents).select("doc_id", F.col("text").alias("sequence"), F.coalesce("source", F.lit("")).alias("source")))
    found = lca.classify(docs, known, nodes, "doc_id", k=config["k"], w=config["w"], key=alphabetic, confidence=config["confidence"])
    # As many rows as records: one that repeats an id is classified with the others of that id, and each is written.
    replacing(docs.select("doc_id", "source").join(found, "doc_id", "left").select(*(x.split()[0] for x in CALLS.split(", "))), "source").parquet(f"{output}/calls")
    calls = written(spark, f"{output}/calls", CALLS).withColumn("source", _name("source"))
    log.info("read %s records, wrote a call of each", calls.count())
    total = F.broadcast(calls.groupBy("source").agg(F.count("*").alias("_n")))
    shares = lca.profile(calls, nodes, "source").join(total, "source").select("taxid", "n_reads", "n_clade", F.round(F.col("n_clade") / F.col("_n"), 9).alias("share"), "source")
    replacing(shares, "source").parquet(f"{output}/profile")
    out = written(spark, f"{output}/profile", PROFILE).withColumn("source", _name("source"))
    log.info("wrote %s rows of the profile", out.count())
    return out


def _name(source: str):
    """A partition of empty name is read back as null."""
    return F.coalesce(source, F.lit(""))


if __name__ == "__main__":
    session, args = command_line("jobs.taxon_profile", __doc__.splitlines()[0], "documents", "panel", "output")
    try:
        run(session, args.documents, args.panel, args.output, load_config(session, args.config, DEFAULTS))
    finally:
        session.stop()
