"""Classification of reads by lowest common ancestors of minimizers.

A taxonomy is a table of root paths. In order of their elements, paths below one node are neighbours, so the lowest common ancestor of any set of nodes is the common
start of the least and the greatest of their paths: two built-in aggregates, merged partially before a shuffle. The database has one row a minimizer, the lowest common
ancestor of all references that hold it; so however many references share a minimizer, a probe meets one row.

A read's distinct minimizers look their nodes up. A node scores the hits of itself and its ancestors; the best one is the call, or the lowest common
ancestor of those that tie. With a confidence, the call moves up until that share of the read's minimizers lies at or below it; a read that no node satisfies, or without
a hit, is unclassified. Each step is a join or an aggregate by read: nothing is gathered in one row, however many nodes a long read hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from germlight.functions.storage import checkpointed
from germlight.operators.minimizers import K, W, Key, canonical, distinct_minimizers, minimizers

#: Rounds of path doubling: paths of 2^MAX_ROUNDS nodes. A taxonomy that takes more has a cycle.
MAX_ROUNDS = 16
UNKNOWN = "unclassified"


def root_paths(taxonomy: DataFrame) -> DataFrame:
    """taxid and path (root ... taxid) of taxonomy(taxid, parent). A node that is its own parent, or whose parent is null or missing, is a root.

    Each round joins every path to the one above it, so a tree of depth d takes log2(d) rounds.
    """
    # Repeated nodes with one parent are one; with several, the least parent counts.
    nodes = taxonomy.select("taxid", F.nullif(F.col("parent"), F.col("taxid")).alias("up")).groupBy("taxid").agg(F.min("up").alias("up"))
    paths = checkpointed(nodes.select("taxid", F.array("taxid").alias("path"), "up"))
    for _ in range(MAX_ROUNDS):
        if paths.where("up IS NOT NULL").isEmpty():
            return paths.select("taxid", "path")
        above = paths.select(F.col("taxid").alias("_t"), F.col("path").alias("_path"), F.col("up").alias("_up"))
        paths = checkpointed(paths.join(above, F.col("up") == F.col("_t"), "left").select("taxid", F.concat(F.coalesce("_path", F.array().cast(paths.schema["path"].dataType)), "path").alias("path"), F.col("_up").alias("up")))
    raise ValueError("the taxonomy has a cycle")


def common_start(a: Column, b: Column) -> Column:
    """Of two root paths: where they agree at a place, they agree at all places before it."""
    return F.slice(a, F.lit(1), F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)))


def lowest_common_ancestors(nodes: DataFrame, *keys: str, path: str = "path") -> DataFrame:
    """keys and path of the lowest common ancestor of each group's nodes; an empty path if they have none."""
    return nodes.groupBy(*keys).agg(F.min(path).alias("_low"), F.max(path).alias("_high")).select(*keys, common_start(F.col("_low"), F.col("_high")).alias("path"))


def database(references: DataFrame, paths: DataFrame, k: int = K, w: int = W, key: Key = canonical) -> DataFrame:
    """(v, taxid): every minimizer of references(taxid, sequence) with its lowest common ancestor. Trees without a common root leave minimizers that they share out."""
    own = minimizers(references, "taxid", k=k, w=w, key=key).select("v", "taxid").distinct().join(paths.select("taxid", "path"), "taxid")
    return lowest_common_ancestors(own, "v").where(F.size("path") > 0).select("v", F.element_at("path", -1).alias("taxid"))


def classify(reads: DataFrame, known: DataFrame, paths: DataFrame, *keys: str, k: int = K, w: int = W, key: Key = canonical, confidence: float = 0.0) -> DataFrame:
    """keys, taxid (null if unclassified), n_minimizers, n_hits, score and support of every read; keys (read_id by default) tell reads apart, and a null key has no call.

    n_minimizers: distinct ones of the read; n_hits: those in the database; score: hits on the way from the root to the call before it moved up; support: hits at or below the call.
    """
    keys = keys or ("read_id",)
    own = distinct_minimizers(reads, *keys, k=k, w=w, key=key)
    hits = checkpointed(own.join(known.select("v", "taxid"), "v", "left").groupBy(*keys, "taxid").agg(F.count("*").alias("n")))
    totals = hits.groupBy(*keys).agg(F.sum("n").alias("n_minimizers"), F.coalesce(F.sum(F.when(F.col("taxid").isNotNull(), F.col("n"))), F.lit(0)).alias("n_hits"))
    hit = hits.where("taxid IS NOT NULL").join(paths.select("taxid", "path"), "taxid")
    ways = hit.select(*keys, "n", "path", F.explode("path").alias("node"))
    scores = ways.select(*keys, "path", "node").join(hits.select(*keys, F.col("taxid").alias("node"), F.col("n").alias("m")), [*keys, "node"]).groupBy(*keys, "path").agg(F.sum("m").alias("score"))
    tied = lowest_common_ancestors(scores, *keys, "score")
    best = tied.groupBy(*keys).agg(F.max("score").alias("score"), F.max_by("path", "score").alias("path"))
    clades = ways.groupBy(*keys, "node").agg(F.sum("n").alias("support"))
    way = best.join(totals.select(*keys, "n_minimizers"), [*keys]).select(*keys, "score", "n_minimizers", F.posexplode("path").alias("depth", "node")).join(clades, [*keys, "node"])
    held = way.where(F.col("support") >= confidence * F.col("n_minimizers")).groupBy(*keys).agg(F.max("score").alias("score"), F.max_by(F.struct(F.col("node").alias("taxid"), "support"), "depth").alias("call"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return reads.select(*keys).distinct().join(totals, [*keys], "left").join(held, [*keys], "left").select(*keys, F.col("call.taxid").alias("taxid"), zero("n_minimizers").alias("n_minimizers"), zero("n_hits").alias("n_hits"), zero("score").alias("score"), zero(F.col("call.support")).alias("support"))


def profile(calls: DataFrame, paths: DataFrame, *groups: str) -> DataFrame:
    """groups, taxid, n_reads (called that node) and n_clade (called it or a node below it), for every node with a read in its clade; taxid null holds the unclassified."""
    at = calls.groupBy(*groups, "taxid").agg(F.count("*").alias("n_reads"))
    clades = at.join(paths.select("taxid", "path"), "taxid").select(*groups, F.explode("path").alias("node"), F.when(F.col("node") == F.col("taxid"), F.col("n_reads")).otherwise(F.lit(0)).alias("own"), "n_reads")
    known = clades.groupBy(*groups, F.col("node").alias("taxid")).agg(F.sum("own").alias("n_reads"), F.sum("n_reads").alias("n_clade"))
    return known.unionByName(at.where("taxid IS NULL").withColumn("n_clade", F.col("n_reads")))


def assignments(reads: DataFrame, calls: DataFrame, names: DataFrame, paths: DataFrame) -> DataFrame:
    """Calls by (read_id, ordinal) in the form of taxonomy.assign's other inputs. names: taxid, name and rank; a call's species and genus are its ancestors (or itself) of these ranks."""
    ranks = paths.select("taxid", F.explode("path").alias("_node")).join(names.where(F.col("rank").isin("species", "genus")).select(F.col("taxid").alias("_node"), "name", "rank"), "_node")
    of = ranks.groupBy("taxid").agg(*(F.max(F.when(F.col("rank") == r, F.col("name"))).alias(r) for r in ("species", "genus")))
    full = reads.select("read_id", "ordinal", F.length("sequence").alias("alignment_length")).join(calls, ["read_id", "ordinal"]).join(of, "taxid", "left")
    share = F.when(F.col("n_minimizers") > 0, F.col("support") / F.col("n_minimizers")).otherwise(F.lit(0.0))
    named = [F.coalesce(r, F.lit(UNKNOWN)).alias(r) for r in ("species", "genus")]
    return full.select("read_id", "ordinal", F.coalesce(F.col("taxid").cast("string"), F.lit("0")).alias("taxid"), *named, share.alias("confidence"), "alignment_length", F.col("n_hits").cast("int").alias("num_kmers"), F.col("species").isNotNull().alias("classified"))
