"""Indexes of sorted BAM files: built by Spark, and used to read only the blocks that a region needs.

An index has, for each reference, bins (nested intervals of 2^29 down to 2^14 bases, eight in each) with the chunks of the file that hold their records, and for each
window of 2^14 bases the first place of a record that reaches into it. A record belongs to the smallest bin that holds it whole. Places are virtual offsets: that of
a block in the file, and 16 bits for the place in the block. A reference's counts of mapped and unmapped records stand in a bin of their own.

Building: tasks read spans of bytes of all files and reduce their records to chunks, windows and counts; those of a file, some thousandth of its size, are put
together in one task, since an index is one file. Files that aren't sorted are refused. An index that is older than its file isn't noticed.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format: magic, first bin of each level with the bits of its intervals, most bases, and the bin of the counts.
MAGIC, LEVELS, LIMIT, COUNTS = b"BAI\1", ((4681, 14), (585, 17), (73, 20), (9, 23), (1, 26)), 1 << 29, 37450
WINDOW = 14
#: Kinds of the rows that a span is reduced to.
CHUNK, LINEAR, PLACES, NUMBERS, ORDER = range(5)
PARTS = "file string, kind int, ref int, bin long, first long, last long"


def bin_of(start: int, end: int) -> int:
    """The smallest bin that holds the bases from start to before end."""
    last = max(end, start + 1) - 1
    for first, bits in LEVELS:
        if start >> bits == last >> bits:
            return first + (start >> bits)
    return 0


def start_of(number: int) -> int:
    """The first base of a bin."""
    return next(((number - first) << bits for first, bits in LEVELS if number >= first), 0)


def bins_over(start: int, end: int) -> set[int]:
    """All bins that share a base with those from start to before end."""
    last = max(end, start + 1) - 1
    return {0, *(b for first, bits in LEVELS for b in range(first + (start >> bits), first + (last >> bits) + 1))}


@dataclass
class Reference:
    bins: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    linear: list[int] = field(default_factory=list)
    span: tuple[int, int] | None = None
    mapped: int = 0
    unmapped: int = 0


@dataclass
class Index:
    references: list[Reference]
    unplaced: int = 0

    def encoded(self) -> bytes:
        out = bytearray(MAGIC + struct.pack("<i", len(self.references)))
        for r in self.references:
            out += struct.pack("<i", len(r.bins) + (r.span is not None))
            for number, chunks in sorted(r.bins.items()):
                out += struct.pack("<Ii", number, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks)
            if r.span is not None:
                out += struct.pack("<IiQQQQ", COUNTS, 2, *r.span, r.mapped, r.unmapped)
            out += struct.pack(f"<i{len(r.linear)}Q", len(r.linear), *r.linear)
        return bytes(out + struct.pack("<Q", self.unplaced))

    def chunks(self, reference: int, start: int, end: int) -> list[tuple[int, int]]:
        """Places (first, last) that hold all records with a base from start to before end, in order and apart."""
        if not 0 <= reference < len(self.references):
            return []
        r = self.references[reference]
        window = start >> WINDOW
        least = r.linear[window] if window < len(r.linear) else (r.linear[-1] if r.linear else 0)
        # The first record of a bin that begins at or after the end does too, and so do all that follow it.
        most = min((c[0][0] for number, c in r.bins.items() if c and start_of(number) >= end), default=1 << 64)
        wanted = bins_over(start, min(end, LIMIT))
        return joined(sorted((max(a, least), min(b, most)) for number in wanted & r.bins.keys() for a, b in r.bins[number] if b > least and a < most))


def joined(chunks: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted chunks; those that overlap or meet in a block become one."""
    out: list[tuple[int, int]] = []
    for a, b in chunks:
        if out and a >> 16 <= out[-1][1] >> 16:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def decoded(data: bytes) -> Index:
    if data[:4] != MAGIC:
        raise ValueError("not a BAM index")
    at = 4

    def take(kinds: str) -> tuple:
        nonlocal at
        values = struct.unpack_from("<" + kinds, data, at)
        at += struct.calcsize("<" + kinds)
        return values

    found = Index([])
    for _ in range(take("i")[0]):
        r = Reference()
        for _ in range(take("i")[0]):
            number, n = take("Ii")
            chunks = [take("QQ") for _ in range(n)]
            if number == COUNTS:
                r.span, (r.mapped, r.unmapped) = chunks[0], chunks[1]
            else:
                r.bins[number] = chunks
        r.linear = list(take(f"{take('i')[0]}Q"))
        found.references.append(r)
    if at + 8 <= len(data):  # may be left out
        found.unplaced = take("Q")[0]
    return found


def read_index(path: str) -> Index | None:
    """The index that stands beside a BAM file; None if there is none."""
    from pyarrow import fs

    from germlight.sources.files import _store

    for name in (f"{path}.bai", f"{path.removesuffix('.bam')}.bai"):
        store, place = _store(name)
        if store.get_file_info(place).type == fs.FileType.File:
            with store.open_input_file(place) as file:
                return decoded(file.read())
    return None


def bins_of(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """bin_of() of many records."""
    last = np.maximum(end, start + 1) - 1
    return np.select([start >> bits == last >> bits for _, bits in LEVELS], [first + (start >> bits) for first, bits in LEVELS], 0)


def _runs(*changes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs begin and end (with the last of them), of rows that begin one where any of changes, from the second row on, is true."""
    begin = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce(changes)]))
    return begin, np.append(begin[1:], len(changes[0]) + 1) - 1


def parts_of(span, records: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple]:
    """The records of a span, many at a time as columns (first, last, ref, start, end, flag), as rows of PARTS: chunks that meet are one."""
    from germlight.functions.scalar import UNMAPPED

    chunks: dict[tuple[int, int], list[list[int]]] = {}
    linear: dict[tuple[int, int], int] = {}
    totals: dict[int, list[int]] = {}
    before = begin = None
    for first, last, ref, start, end, flag in records:
        # Records without a place come last.
        key = np.where(ref >= 0, ref, 1 << 30) << 32 | start + 1
        if np.any(key[1:] < key[:-1]) or (before is not None and key[0] < before):
            raise ValueError(f"{span.path} isn't sorted by coordinate")
        begin, before = begin or (int(first[0]), int(key[0])), int(key[-1])
        unmapped = flag & UNMAPPED != 0
        a, b = _runs(ref[1:] != ref[:-1])
        n_unmapped = np.add.reduceat(unmapped.astype(np.int64), a)
        for r, x, y, n, none in zip(ref[a].tolist(), first[a].tolist(), last[b].tolist(), (b - a + 1).tolist(), n_unmapped.tolist()):
            own = totals.setdefault(r, [x, y, 0, 0])
            own[1], own[2], own[3] = y, own[2] + n - none, own[3] + none
        placed = (ref >= 0) & (start >= 0)
        if not placed.any():
            continue
        first, last, ref, start, end = (x[placed] for x in (first, last, ref, start, end))
        if end.max() > LIMIT:
            raise ValueError("positions of 2^29 or more have no bin")
        number = ref << 32 | bins_of(start, end)
        order = np.argsort(number, kind="stable")
        number, x, y = number[order], first[order], last[order]
        a, b = _runs(number[1:] != number[:-1], x[1:] >> 16 > y[:-1] >> 16)
        for n, x, y in zip(number[a].tolist(), x[a].tolist(), y[b].tolist()):
            known = chunks.setdefault((n >> 32, n & 0xFFFFFFFF), [])
            if known and x >> 16 <= known[-1][1] >> 16:
                known[-1][1] = y
            else:
                known.append([x, y])
        low, high = start >> WINDOW, np.maximum(end, start + 1) - 1 >> WINDOW
        # A window's first record is one that reaches into it from before, or one that begins in it.
        for i in np.flatnonzero(high > low).tolist():
            for w in range(int(low[i]) + 1, int(high[i]) + 1):
                linear.setdefault((int(ref[i]), w), int(first[i]))
        window, at = np.unique(ref << 32 | low, return_index=True)
        for w, x in zip(window.tolist(), first[at].tolist()):
            linear[w >> 32, w & 0xFFFFFFFF] = min(x, linear.get((w >> 32, w & 0xFFFFFFFF), x))
    for (ref, number), known in chunks.items():
        for first, last in known:
            yield span.path, CHUNK, ref, number, first, last
    for (ref, w), first in linear.items():
        yield span.path, LINEAR, ref, w, first, 0
    for ref, (first, last, mapped, unmapped) in totals.items():
        yield span.path, PLACES, ref, 0, first, last
        yield span.path, NUMBERS, ref, 0, mapped, unmapped
    if begin is not None:
        yield span.path, ORDER, -1, begin[0], begin[1], before


def assembled(parts: Iterable[tuple[int, int, int, int, int]], n_references: int) -> Index:
    """The index of a file from the rows (kind, ref, bin, first, last) of its spans."""
    found = Index([Reference() for _ in range(n_references)])
    rows = sorted(parts)
    order = [(first, last) for kind, _, _, first, last in rows if kind == ORDER]
    if any(a[1] > b[0] for a, b in zip(order, order[1:])):
        raise ValueError("a file that isn't sorted by coordinate has no index")
    for (kind, ref, number), group in groupby((x for x in rows if x[0] != ORDER), lambda x: x[:3]):
        values = [x[3:] for x in group]
        r = found.references[ref] if ref >= 0 else None
        if kind == NUMBERS and r is None:
            found.unplaced = sum(a + b for a, b in values)
        elif r is None:
            continue
        elif kind == CHUNK:
            r.bins[number] = joined(values)
        elif kind == LINEAR:
            # Windows that no record reaches into have the place of the one before.
            r.linear += [r.linear[-1] if r.linear else 0] * (number - len(r.linear)) + [min(a for a, _ in values)]
        elif kind == PLACES:
            r.span = (min(a for a, _ in values), max(b for _, b in values))
        else:
            r.mapped, r.unmapped = sum(a for a, _ in values), sum(b for _, b in values)
    return found


def write_index(spark: SparkSession, path: str, split: int | None = None) -> int:
    """Writes x.bam.bai beside each BAM file of a path and returns their number. An index of a run before is replaced; a task that is run again writes the same."""
    from germlight.sources import register

    def each(frame: pd.DataFrame) -> pd.DataFrame:
        from germlight.sources.bam import Blocks, read_header
        from germlight.sources.files import _store, open_file

        name = frame["file"].iloc[0]
        with open_file(name) as raw:
            n = len(read_header(Blocks(io.BufferedReader(raw, 1 << 16))))
        data = assembled(frame[["kind", "ref", "bin", "first", "last"]].dropna().astype("int64").itertuples(index=False, name=None), n).encoded()
        store, place = _store(f"{name}.bai")
        with store.open_output_stream(place) as out:
            out.write(data)
        return pd.DataFrame({"file": [name]})

    register(spark)
    reader = spark.read.format("bam_parts")
    parts = (reader.option("split", split) if split else reader).load(path)
    return parts.groupBy("file").applyInPandas(each, "file string").agg(F.count("*").alias("n")).first()["n"]


def index_totals(spark: SparkSession, path: str) -> DataFrame:
    """(file, mapped, unmapped) of every BAM file of a path from its index, without the file; null where there is none."""
    from germlight.sources.files import list_files

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name in frame["file"]:
                index = read_index(name)
                own = (None, None) if index is None else (sum(r.mapped for r in index.references), sum(r.unmapped for r in index.references) + index.unplaced)
                yield pd.DataFrame({"file": [name], "mapped": pd.Series([own[0]], dtype="Int64"), "unmapped": pd.Series([own[1]], dtype="Int64")})

    files = spark.createDataFrame([(name,) for name, _ in list_files(path, (".bam",))], "file string")
    return files.mapInPandas(each, "file string, mapped long, unmapped long")
