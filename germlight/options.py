"""Options of the pipeline: command line over configuration file over defaults."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from typing import Any

#: Where the documented configuration file keeps each option.
CONFIG_PATHS = {
    ("host_filter", "mapq_threshold"): "host_mapq",
    ("host_filter", "identity_threshold"): "host_identity",
    ("quantification", "method"): "quant_method",
    ("quantification", "umi_dedup_method"): "umi_dedup_method",
    ("contamination", "ambient_cutoff"): "ambient_cutoff",
    ("contamination", "min_cells"): "min_cells",
    ("contamination", "specificity_threshold"): "specificity_threshold",
    ("output", "formats"): "formats",
}
CHOICES = {
    "aligner": ("kmer", "chain", "lca", "minimap2", "bowtie2", "kraken2"),
    "quant_method": ("umi", "reads"),
    "umi_dedup_method": ("exact", "hamming"),
    "contamination_method": ("ambient", "prevalence", "both", "none"),
    "host_mode": ("identity", "any_hit"),
    "kraken_mode": ("lineage", "names"),
}


@dataclass(frozen=True)
class Options:
    barcode_tag: str = "CB"
    umi_tag: str = "UB"
    include_unmapped: bool = True
    include_low_mapq: bool = True
    host_mapq: int = 30
    host_identity: float = 95.0
    host_min_aligned: int = 0
    host_mode: str = "identity"
    min_microbe_mapq: int = 1
    min_confidence: float = 0.0
    aligner: str = "kmer"
    kraken_mode: str = "lineage"
    quant_method: str = "umi"
    umi_dedup_method: str = "exact"
    umi_threshold: int = 1
    contamination_method: str = "ambient"
    ambient_cutoff: float = 0.1
    min_reads_per_cell: int = 1
    min_cells: int = 3
    specificity_threshold: float = 2.0
    skip_contamination_filter: bool = False
    formats: tuple[str, ...] = ("mtx", "tsv")

    def __post_init__(self) -> None:
        for name, allowed in CHOICES.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {', '.join(allowed)}, not {getattr(self, name)!r}")

    def updated(self, values: Mapping[str, Any]) -> Options:
        """These options with those of values that aren't None."""
        known = {f.name for f in fields(self)}
        if unknown := set(values) - known:
            raise ValueError(f"unknown options: {', '.join(sorted(unknown))}")
        return replace(self, **{k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if v is not None})


def from_config(config: Mapping[str, Any]) -> dict[str, Any]:
    """Option values of a parsed configuration file; sections that aren't known are left alone."""
    return {name: config[section][key] for (section, key), name in CONFIG_PATHS.items() if key in (config.get(section) or {})}


def load_config(path: str | None) -> dict[str, Any]:
    """A YAML file as a nested dict; no path, or an empty file, is an empty one. PyYAML is used if it is there, else a reader of this file's own form:
    sections of `key: value` lines, with lists as `- item` or [a, b]."""
    if not path:
        return {}
    with open(path) as file:
        text = file.read()
    try:
        import yaml
    except ImportError:
        return _sections(text)
    return yaml.safe_load(text) or {}


def _scalar(text: str) -> Any:
    text = text.strip().strip("\"'")
    if text.startswith("[") and text.endswith("]"):
        return [_scalar(x) for x in text[1:-1].split(",") if x.strip()]
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return {"true": True, "false": False, "null": None, "": None}.get(text.lower(), text)


def _sections(text: str) -> dict[str, Any]:
    found: dict[str, Any] = {}
    section = key = None
    for line in text.splitlines():
        line = line.split(" #")[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        bare = line.strip()
        if bare.startswith("- ") and section is not None and key is not None:
            if not isinstance(found[section].get(key), list):
                found[section][key] = []
            found[section][key].append(_scalar(bare[2:]))
            continue
        name, _, value = bare.partition(":")
        if line[0] != " ":
            section, key = name, None
            found[section] = _scalar(value) if value.strip() else {}
        elif isinstance(found.get(section), dict):
            key = name
            found[section][key] = _scalar(value)
    return found
