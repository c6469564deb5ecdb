"""Matrix views of the long counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def coo(counts: DataFrame, species: DataFrame, cells: DataFrame) -> DataFrame:
    """1-based (cell, microbe, n) of the nonzero entries. The dimension tables join by key; the planner broadcasts small ones."""
    return counts.where("n <> 0").join(species, "species").join(cells, "barcode").select((F.col("cell_idx") + 1).alias("cell"), (F.col("species_idx") + 1).alias("microbe"), "n")


def dense(counts: DataFrame, barcodes: list[str]) -> DataFrame:
    """species by barcode, zeros filled in; the columns are named, so the planner needs no pass to find them."""
    wide = counts.groupBy("species").pivot("barcode", barcodes).agg(F.sum("n"))
    return wide.fillna(0)


def dense_rows(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """(species, n): for each species the counts of all cells, in the order of cell_idx (0 ... in cells), zeros filled in. A row is as long as there are cells."""
    one = counts.join(cells, "barcode").groupBy("species", "cell_idx").agg(F.sum("n").cast("long").alias("n"))
    found = one.groupBy("species").agg(F.array_sort(F.collect_list(F.struct("cell_idx", "n"))).alias("own"))
    zeros = lambda k: F.array_repeat(F.lit(0).cast("long"), k.cast("int"))
    before = lambda i: F.coalesce(F.get("own", i - 1)["cell_idx"], F.lit(-1))
    filled = F.flatten(F.transform("own", lambda x, i: F.concat(zeros(x["cell_idx"] - before(i) - 1), F.array(x["n"]))))
    rest = zeros(F.col("cells") - F.element_at("own", -1)["cell_idx"] - 1)
    return found.crossJoin(F.broadcast(cells.agg(F.count("*").alias("cells")))).select("species", F.concat(filled, rest).alias("n"))


def cell_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("barcode").agg(F.sum("n").alias("total"))
