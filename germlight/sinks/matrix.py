"""Matrix files: Matrix Market trio, dense TSV, H5AD. Each format is one file: Spark writes its sorted lines as parts, which are then joined (see joined); H5AD is made in the driver."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from germlight.operators import matrix
from germlight.operators.quantify import cell_dim, species_dim
from germlight.sinks.joined import Scratch, without_last_byte, write_joined

#: Fixed value: the first line of a matrix file.
BANNER = "%%MatrixMarket matrix coordinate integer general\n%\n"
#: Entries up to which the H5AD file's matrix, which is made in the driver, is written.
MAX_H5AD_ENTRIES = 50_000_000
FORMATS = ("mtx", "tsv", "h5ad")


def _names(dim: DataFrame, key: str, index: str) -> Iterator[str]:
    for row in dim.orderBy(index).select(key).toLocalIterator():
        yield row[0]


def _name(key: str, index: str, default: str | None) -> Column:
    return F.concat(F.lit(f"{default}_"), F.col(index).cast("string")) if default else F.col(key)


def write_mtx(counts: DataFrame, folder: str, species: DataFrame | None = None, cells: DataFrame | None = None, orientation: str = "cells_x_features", default_names: bool = False) -> None:
    """matrix.mtx, barcodes.tsv and features.tsv. species and cells are dimension tables; by default those of counts."""
    if orientation not in ("cells_x_features", "features_x_cells"):
        raise ValueError(f"unknown orientation {orientation!r}")
    spark, species, cells = counts.sparkSession, species or species_dim(counts), cells or cell_dim(counts)
    with Scratch(spark) as scratch:
        for name, dim, key, index, default in (("barcodes.tsv", cells, "barcode", "cell_idx", "cell"), ("features.tsv", species, "species", "species_idx", "species")):
            write_joined(spark, scratch.parts(dim.sort(index), _name(key, index, default if default_names else None)), f"{folder}/{name}")
        size = {"cell": cells.count(), "microbe": species.count()}
        entries = matrix.coo(counts, species, cells)
        order = ("cell", "microbe") if orientation == "cells_x_features" else ("microbe", "cell")
        head = f"{BANNER}{size[order[0]]} {size[order[1]]} {entries.count()}\n"
        # Sorted the way the format's usual writers do, by column and then row.
        lines = scratch.parts(entries.sort(order[1], order[0]), F.concat_ws(" ", *(F.col(c).cast("string") for c in (*order, "n"))))
        write_joined(spark, [head.encode(), *lines], f"{folder}/matrix.mtx")


def write_tsv(counts: DataFrame, path: str, species: DataFrame | None = None, cells: DataFrame | None = None, default_names: bool = False) -> None:
    """Species by cells with an empty first header cell. The header's cells are rows until they are joined; a species' line is one row."""
    spark, species, cells = counts.sparkSession, species or species_dim(counts), cells or cell_dim(counts)
    absent = F.array_repeat(F.lit(0).cast("long"), cells.count())
    rows = species.join(matrix.dense_rows(counts, cells), "species", "left").withColumn("n", F.coalesce("n", absent))
    with Scratch(spark) as scratch:
        names = scratch.parts(cells.sort("cell_idx"), _name("barcode", "cell_idx", "cell" if default_names else None), "\t")
        head = [b"\t", *without_last_byte(names)] if names else []
        lines = scratch.parts(rows.sort("species_idx"), F.concat_ws("\t", _name("species", "species_idx", "species" if default_names else None), F.col("n").cast("array<string>")))
        write_joined(spark, [*head, b"\n", *lines], path)


def write_h5ad(counts: DataFrame, path: str, species: DataFrame | None = None, cells: DataFrame | None = None) -> None:
    """Cells by microbes, sparse. Needs anndata and scipy."""
    try:
        import anndata
        import pandas as pd
        import scipy.sparse as sp
    except ImportError as e:
        raise RuntimeError(f"writing H5AD needs anndata and scipy ({e.name} is missing); the mtx format holds the same matrix") from e
    species, cells = species or species_dim(counts), cells or cell_dim(counts)
    entries = matrix.coo(counts, species, cells)
    if (n := entries.count()) > MAX_H5AD_ENTRIES:
        raise ValueError(f"{n} entries are too many for an H5AD file made in the driver; the mtx format holds the same matrix")
    e = entries.toPandas()
    barcodes, names = list(_names(cells, "barcode", "cell_idx")), list(_names(species, "species", "species_idx"))
    x = sp.csr_matrix((e["n"], (e["cell"] - 1, e["microbe"] - 1)), shape=(len(barcodes), len(names)))
    anndata.AnnData(X=x, obs=pd.DataFrame({"cell_barcode": barcodes}, index=barcodes), var=pd.DataFrame({"species": names}, index=names)).write_h5ad(path)


def write_matrix(counts: DataFrame, folder: str, formats: tuple[str, ...] = ("mtx", "tsv"), species: DataFrame | None = None, cells: DataFrame | None = None, prefix: str = "germlight", default_names: bool = False) -> None:
    if unknown := set(formats) - set(FORMATS):
        raise ValueError(f"unknown formats: {', '.join(sorted(unknown))}")
    os.makedirs(folder, exist_ok=True)
    if "mtx" in formats:
        write_mtx(counts, os.path.join(folder, "mtx"), species, cells, default_names=default_names)
    if "tsv" in formats:
        write_tsv(counts, os.path.join(folder, f"{prefix}_matrix.tsv"), species, cells, default_names)
    if "h5ad" in formats:
        write_h5ad(counts, os.path.join(folder, f"{prefix}.h5ad"), species, cells)
