"""What the jobs share: configuration, settings that are put back, reading of what earlier runs wrote, and the command line's session."""

from __future__ import annotations

import argparse
import contextlib
import json
import logging
from collections.abc import Iterator, Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

log = logging.getLogger("germlight.jobs")


def load_config(spark: SparkSession, path: str | None, defaults: Mapping[str, Any]) -> dict[str, Any]:
    """defaults, with the values of a small JSON file over them; it may lie on any store that Spark reads. Unknown names are errors."""
    own = json.loads(spark.read.text(path, wholetext=True).first()["value"]) if path else {}
    if unknown := set(own) - set(defaults):
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return {**defaults, **own}


@contextlib.contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Spark settings for a while; afterwards they are as before."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def as_pattern(path: str) -> str:
    """A glob of this one path: a file stream takes a single file under a pattern only, and a folder either way."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def written(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What is under path; no rows before the first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replacing(df: DataFrame, *partitions: str) -> DataFrameWriter:
    """A writer that replaces the partitions that df has rows for, and leaves the others: a second run of the same work leaves the same files' contents.
    A partition with many rows is written by several tasks."""
    return df.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)


def command_line(module: str, about: str, *paths: str) -> tuple[SparkSession, argparse.Namespace]:
    """Session and parsed arguments: a required --PATH for each of paths, and --config."""
    p = argparse.ArgumentParser(prog=f"python -m {module}", description=about)
    for name in paths:
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--config", help="JSON file of settings")
    args = p.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    return SparkSession.builder.appName(module).getOrCreate(), args
