"""Quality summary of a count table, zeros included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from germlight.operators.quantiles import percentiles, value_runs


def _vector(counts: DataFrame, dim: DataFrame, key: str, value, metric: str) -> DataFrame:
    own = counts.groupBy(key).agg(value.alias("v"))
    return dim.select(key).join(own, key, "left").select(F.lit(metric).alias("metric"), F.coalesce("v", F.lit(0)).cast("double").alias("v"))


def qc_summary(counts: DataFrame, species: DataFrame, cells: DataFrame) -> DataFrame:
    """metric, mean, median, max and min of four vectors, zeros of absent keys included; a vector without keys has no row. Distinct values with their counts are written out once."""
    positive = F.count_if(F.col("n") > 0)
    all_ = _vector(counts, cells, "barcode", positive, "microbes_per_cell")
    for dim, key, value, metric in ((cells, "barcode", F.sum("n"), "reads_per_cell"), (species, "species", positive, "cells_per_microbe"), (species, "species", F.sum("n"), "reads_per_microbe")):
        all_ = all_.unionByName(_vector(counts, dim, key, value, metric))
    runs = value_runs(all_, "metric", "v")
    rest = runs.groupBy("group").agg((F.sum(F.col("v") * F.col("m")) / F.sum("m")).alias("mean"), F.max("v").alias("max"), F.min("v").alias("min"))
    return rest.join(percentiles(runs, 0.5), "group").select(F.col("group").alias("metric"), "mean", F.col("percentile").alias("median"), "max", "min")


def matrix_summary(counts: DataFrame, species: DataFrame, cells: DataFrame) -> DataFrame:
    """One row: n_species, n_cells, total, nnz and sparsity; an empty matrix has sparsity 0."""
    own = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count_if(F.col("n") != 0).alias("nnz"))
    shape = species.agg(F.count("*").alias("n_species")).crossJoin(cells.agg(F.count("*").alias("n_cells")))  # single rows
    full = F.col("n_species") * F.col("n_cells")
    return shape.crossJoin(own).select("n_species", "n_cells", "total", "nnz", F.when(full > 0, 1 - F.col("nnz") / full).otherwise(F.lit(0.0)).alias("sparsity"))
