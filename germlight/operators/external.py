"""Optional external aligners, where their programs are on every executor's PATH: reads go in, SAM or classifier lines come out, a process a partition."""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def minimap2_command(reference: str, threads: int = 1) -> list[str]:
    return ["minimap2", "-ax", "sr", "-t", str(threads), "--secondary=no", reference]


def kraken2_command(database: str, threads: int = 1) -> list[str]:
    return ["kraken2", "--db", database, "--threads", str(threads), "--use-names", "--output", "-"]


def lines_of(reads: DataFrame, command: list[str]) -> DataFrame:
    """(value, ordinal): the lines that the command prints for each partition's reads, given as a FASTQ file. A failing command fails the task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if shutil.which(command[0]) is None:
            raise RuntimeError(f"{command[0]} is not on this executor's PATH")
        with tempfile.TemporaryDirectory() as folder:  # scratch of this one task; nothing outlives it
            name, said = os.path.join(folder, "reads.fastq"), os.path.join(folder, "stderr")
            with open(name, "w") as out:
                for frame in frames:
                    for read_id, sequence, quality in zip(frame["read_id"], frame["sequence"], frame["quality"]):
                        out.write(f"@{read_id}\n{sequence or ''}\n+\n{quality or ''}\n")
            with open(said, "w") as errors:  # a file can't fill up as a pipe can
                process = subprocess.Popen([*command, name], stdout=subprocess.PIPE, stderr=errors, text=True)
                batch: list[str] = []
                at = 0
                for line in process.stdout:
                    batch.append(line.rstrip("\n"))
                    if len(batch) == 4096:
                        yield pd.DataFrame({"value": batch, "line": range(at, at + len(batch))})
                        at, batch = at + len(batch), []
                if batch:
                    yield pd.DataFrame({"value": batch, "line": range(at, at + len(batch))})
                if process.wait():
                    with open(said) as errors:
                        raise RuntimeError(f"{command[0]} ended with {process.returncode}: {errors.read()[-500:]}")

    out = reads.select("read_id", "sequence", "quality").mapInPandas(run, "value string, line long")
    return out.select("value", F.shiftleft(F.spark_partition_id().cast("long"), 40).bitwiseOR(F.col("line")).alias("ordinal"))
