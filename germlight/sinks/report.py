"""Statistics as JSON, and a quality report as text."""

from __future__ import annotations

import json
import os
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame

from germlight.operators import qc

#: Fixed value: the report's vectors in its order, with their titles.
TITLES = {"microbes_per_cell": "Microbes per cell", "reads_per_cell": "Reads per cell", "cells_per_microbe": "Cells per microbe", "reads_per_microbe": "Reads per microbe"}


def plain(value: Any) -> Any:
    """JSON's own types: numpy and decimal numbers become int or float, tuples lists."""
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    return value.item() if hasattr(value, "item") else value


def write_stats(stats: dict[str, Any], path: str) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w") as out:
        json.dump(plain(stats), out, indent=2)


def qc_report(counts: DataFrame, species: DataFrame, cells: DataFrame) -> str:
    """The report's text; an empty matrix gives zeros."""
    shape = qc.matrix_summary(counts, species, cells).first()
    vectors = {r["metric"]: r for r in qc.qc_summary(counts, species, cells).collect()}  # four rows
    lines = ["Quality report", "=" * 14, "", f"Species: {shape['n_species']:,}", f"Cells: {shape['n_cells']:,}", f"Total counts: {shape['total']:,}", f"Nonzero entries: {shape['nnz']:,}", f"Sparsity: {shape['sparsity']:.4f}"]
    for metric, title in TITLES.items():
        v = vectors.get(metric)
        mean, median, most, least = (v["mean"], v["median"], v["max"], v["min"]) if v else (0, 0, 0, 0)
        lines += ["", f"{title}:", f"  Mean: {mean:.2f}", f"  Median: {median:.2f}", f"  Max: {most:,.0f}", f"  Min: {least:,.0f}"]
    return "\n".join(lines) + "\n"


def write_qc_report(counts: DataFrame, species: DataFrame, cells: DataFrame, path: str) -> str:
    text = qc_report(counts, species, cells)
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w") as out:
        out.write(text)
    return text


def write_summary(folder: str, path: str | None = None) -> str:
    """A list of the output files and their sizes."""
    found = sorted((os.path.relpath(os.path.join(d, f), folder), os.path.getsize(os.path.join(d, f))) for d, _, names in os.walk(folder) for f in names)
    text = "\n".join(["Output files", "=" * 12, *(f"{size:>12,}  {name}" for name, size in found)]) + "\n"
    with open(path or os.path.join(folder, "summary.txt"), "w") as out:
        out.write(text)
    return text
