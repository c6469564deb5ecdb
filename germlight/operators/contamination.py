"""Contamination: ambient, prevalence and specificity rules, ambient profile and correction, doublets.

Every statistic runs over all N cells, zeros included, from the stored entries alone: N is one number, and absent cells add nothing to the sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from germlight.operators.quantiles import percentiles, value_runs


def n_cells(counts: DataFrame) -> DataFrame:
    """One row: the number of cells with a count for any species."""
    return counts.agg(F.countDistinct("barcode").alias("n_cells"))


def _with_cells(per_species: DataFrame, counts: DataFrame, cells: DataFrame | None) -> DataFrame:
    size = n_cells(counts) if cells is None else cells.agg(F.count("*").alias("n_cells"))
    return per_species.crossJoin(F.broadcast(size))  # one row


def ambient_scores(counts: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """species, nz, total, mean_positive, fraction and max_count. cells is cell_dim where it isn't that of counts."""
    own = counts.where("n > 0").groupBy("species").agg(F.count("*").alias("nz"), F.sum("n").alias("total"), F.max("n").alias("max_count"))
    return _with_cells(own, counts, cells).select("species", "nz", "total", (F.col("total") / F.col("nz")).alias("mean_positive"), (F.col("nz") / F.col("n_cells")).alias("fraction"), "max_count")


def is_ambient(cutoff: float = 0.1, min_reads_per_cell: int = 1) -> Column:
    """In many cells, with few reads in each and never many: all strict."""
    return (F.col("fraction") > cutoff) & (F.col("mean_positive") < 2 * min_reads_per_cell) & (F.col("max_count") < 5 * min_reads_per_cell)


def specificity_scores(counts: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """species, mean, std (population), cv, gini and specificity = cv * (1 + gini).

    gini = (N + 1 - 2 S / T) / N with S = sum of x_k * (c - k + 1) over the c stored entries in ascending order. Entries of equal value are counted
    together first: a run of m entries of value x that follows k others adds x * (m * (c - k) - m * (m - 1) / 2), so a species costs a sort of its distinct
    values, not of its cells.
    """
    runs = counts.where("n > 0").groupBy("species", "n").agg(F.count("*").alias("m"))
    by = Window.partitionBy("species")
    runs = runs.withColumns({"c": F.sum("m").over(by), "k": F.sum("m").over(by.orderBy("n")) - F.col("m")})
    part = F.col("n") * (F.col("m") * (F.col("c") - F.col("k")) - F.col("m") * (F.col("m") - 1) / 2)
    own = runs.groupBy("species").agg(F.sum(F.col("n") * F.col("m")).alias("total"), F.sum(F.col("n") * F.col("n") * F.col("m")).alias("square"), F.sum(part).alias("s"))
    size, mean = F.col("n_cells"), F.col("total") / F.col("n_cells")
    std = F.sqrt(F.greatest(F.col("square") / size - mean * mean, F.lit(0.0)))
    scored = _with_cells(own, counts, cells).select("species", mean.alias("mean"), std.alias("std"), (std / mean).alias("cv"), ((size + 1 - 2 * F.col("s") / F.col("total")) / size).alias("gini"))
    return scored.withColumn("specificity", F.col("cv") * (1 + F.col("gini")))


def species_masks(counts: DataFrame, method: str = "ambient", ambient_cutoff: float = 0.1, min_reads_per_cell: int = 1, min_cells: int = 3, specificity_threshold: float = 2.0, cells: DataFrame | None = None) -> DataFrame:
    """species, keep_ambient, keep_prevalence, keep_specificity and keep. Rules that the method leaves out keep everything."""
    if method not in ("ambient", "prevalence", "both", "none"):
        raise ValueError(f"unknown contamination method {method!r}")
    both = ambient_scores(counts, cells).join(specificity_scores(counts, cells).select("species", "specificity"), "species")
    masks = both.select(
        "species",
        (~is_ambient(ambient_cutoff, min_reads_per_cell) if method in ("ambient", "both") else F.lit(True)).alias("keep_ambient"),
        (F.col("nz") >= min_cells if method in ("prevalence", "both") else F.lit(True)).alias("keep_prevalence"),
        (F.col("specificity") >= specificity_threshold).alias("keep_specificity"),
    )
    return masks.withColumn("keep", F.col("keep_ambient") & F.col("keep_prevalence") & F.col("keep_specificity"))


def decontaminated(counts: DataFrame, masks: DataFrame) -> DataFrame:
    """Counts of the kept species; cells that lose all of theirs stay in cell_dim."""
    return counts.join(masks.where("keep").select("species"), "species", "left_semi")


def contamination_stats(masks: DataFrame) -> DataFrame:
    """One row; each rule's count is over all species, so overlaps count more than once."""
    return masks.agg(
        F.count("*").alias("input_species"),
        F.count_if(~F.col("keep_ambient")).alias("filtered_ambient"),
        F.count_if(~F.col("keep_prevalence")).alias("filtered_low_prevalence"),
        F.count_if(~F.col("keep_specificity")).alias("filtered_low_specificity"),
        F.count_if("keep").alias("retained"),
    )


def ambient_profile(counts: DataFrame, percentile: float = 0.1) -> DataFrame:
    """species and ambient_frac: each species' share of the counts in cells of at most that percentile (exact, interpolated) of cell totals. Empty if those
    cells hold nothing."""
    totals = counts.groupBy("barcode").agg(F.sum("n").alias("total"))
    limit = percentiles(value_runs(totals.withColumn("one", F.lit(0)), "one", "total"), percentile).withColumnRenamed("percentile", "cut")  # one row
    empties = totals.crossJoin(F.broadcast(limit)).where("total <= cut").select("barcode")
    own = counts.join(empties, "barcode", "left_semi").groupBy("species").agg(F.sum("n").alias("ambient"))
    grand = own.agg(F.sum("ambient").alias("grand"))
    all_species = counts.select("species").distinct()
    share = F.coalesce(F.col("ambient"), F.lit(0)) / F.col("grand")
    return all_species.join(own, "species", "left").crossJoin(F.broadcast(grand)).where("grand > 0").select("species", share.alias("ambient_frac"))


def ambient_corrected(counts: DataFrame, profile: DataFrame) -> DataFrame:
    """counts as float: max(0, n - cell total * ambient share). Without a profile they stay as they are; absent cells stay zero."""
    totals = counts.groupBy("barcode").agg(F.sum("n").alias("total"))
    joined = counts.join(totals, "barcode").join(profile, "species", "left")
    left = F.col("n") - F.col("total") * F.coalesce(F.col("ambient_frac"), F.lit(0.0))
    return joined.select("species", "barcode", F.greatest(F.lit(0.0), left).cast("float").alias("n"))


def microbes_per_cell(counts: DataFrame) -> DataFrame:
    return counts.groupBy("barcode").agg(F.count_if(F.col("n") > 0).alias("n_microbes"))


def doublets(counts: DataFrame, max_microbes_per_cell: int = 3) -> DataFrame:
    """Cells with more microbes than that."""
    return microbes_per_cell(counts).where(F.col("n_microbes") > max_microbes_per_cell)
