"""Gapped alignment of reads to references: seed, chain, extend.

Seeds are canonical minimizers. The index has one row for each: how many places it has, and the first MAX_PLACES of them, so that a probe meets one row whatever
repeats the references hold. A read uses its minimizers of at most MAX_PLACES places; only one that has none such uses its least frequent one, whose first places
stand for all (its mapping quality is 0 then, as for every read that fits two places equally well).

In each read the places become anchors, and colinear anchors chains, by dynamic programming over gaps in read and reference. The best CANDIDATES chains are extended
to alignments of the whole read: affine gaps in a band around the chain, over batches of reads at once; ends that don't fit are clipped where
that scores END_BONUS better. The alignment of highest score is reported; ties go to the smaller reference name, start and strand.

Reads are told apart by (read_id, ordinal), neither of which may be null: such reads, and those without a seed, are not aligned. A read's bases are shuffled to
their seeds and to the pieces of reference that they cover, and never gathered with other reads'. Reads of equal bases are aligned once; each then meets the
alignment of its bases by their MD5, 16 bytes, or without any shuffle where the reads are known to be of few sequences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from germlight.operators.kmer import BASES, SMALL_BASES, complement, is_small, met, pieces
from germlight.operators.minimizers import K, W, minimizers

MAX_PLACES, CANDIDATES = 64, 4
#: Of chains: anchors looked back at, widest gap. Of bands: least half-width. Cells of a batch of alignments.
LOOK_BACK, MAX_GAP, PAD, CELLS = 64, 200, 16, 1 << 21
#: Scores of short-read alignment.
MATCH, MISMATCH, OPEN, EXTEND, END_BONUS = 2, 8, 12, 2, 10
NEVER = -(1 << 28)
#: Bytes of alignments that may be broadcast.
SMALL_FOUND = 1 << 24
COMPLEMENT = str.maketrans("ACGTacgt", "TGCATGCA")


@dataclass(frozen=True)
class Index:
    """seeds: v, n, places(reference, position, flipped); bases: reference, piece, bases. small: both may be broadcast; larger ones are shuffled."""

    seeds: DataFrame
    bases: DataFrame
    k: int = K
    w: int = W
    small: bool = False


def build_index(references: DataFrame, k: int = K, w: int = W, max_places: int = MAX_PLACES) -> Index:
    """Of references(reference, sequence). Numbers of places are counted, and the first ones chosen, before anything of a frequent minimizer meets in one task."""
    found = minimizers(references.select("reference", F.upper("sequence").alias("sequence")), "reference", k=k, w=w).select("v", "reference", "position", "flipped").distinct()
    first = found.withColumn("_i", F.row_number().over(Window.partitionBy("v").orderBy("reference", "position"))).where(F.col("_i") <= max_places)
    lists = first.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("reference", "position", "flipped"))).alias("places"))
    return Index(found.groupBy("v").agg(F.count("*").alias("n")).join(met(lists, False), "v"), pieces(references), k, w, is_small(references))


def write_index(index: Index, path: str, mode: str = "errorifexists") -> None:
    """As Parquet; seeds ranged by minimizer, pieces by reference and place."""
    index.seeds.withColumns({"k": F.lit(index.k), "w": F.lit(index.w)}).repartitionByRange("v").sortWithinPartitions("v").write.mode(mode).parquet(f"{path}/seeds")
    index.bases.repartitionByRange("reference", "piece").sortWithinPartitions("reference", "piece").write.mode(mode).parquet(f"{path}/bases")


def read_index(spark: SparkSession, path: str) -> Index | None:
    """A written index; None where there is none."""
    try:
        seeds, bases = spark.read.parquet(f"{path}/seeds"), spark.read.parquet(f"{path}/bases")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    k, w = seeds.select("k", "w").first() or (K, W)
    return Index(seeds.drop("k", "w"), bases, k, w, bases.count() * BASES <= SMALL_BASES)


# Chains


def gap_cost(gap: np.ndarray, k: int) -> np.ndarray:
    return np.where(gap > 0, 0.01 * k * gap + 0.5 * np.log2(np.maximum(gap, 1)), 0.0)


def chained(r: np.ndarray, q: np.ndarray, k: int) -> list[tuple[float, list[int]]]:
    """(score, anchors) of disjoint chains of anchors of one reference and strand, sorted by r; the best first."""
    steps = np.diff(r)
    if len(r) == 1 or (steps > 0).all() and (steps == np.diff(q)).all():  # one diagonal: all of it is the best chain
        return [(float(k + np.minimum(steps, k).sum()), list(range(len(r))))]
    score, before = np.full(len(r), float(k)), np.full(len(r), -1)
    for i in range(1, len(r)):
        j = slice(max(0, i - LOOK_BACK), i)
        dr, dq = r[i] - r[j], q[i] - q[j]
        gap = np.abs(dr - dq)
        found = np.where((dr > 0) & (dq > 0) & (gap <= MAX_GAP), score[j] + np.minimum(np.minimum(dr, dq), k) - gap_cost(gap, k), 0.0)
        best = len(found) - 1 - int(found[::-1].argmax())  # the nearest of equals
        if found[best] > k:
            score[i], before[i] = found[best], j.start + best
    out, used = [], np.zeros(len(r), bool)
    for end in np.argsort(-score, kind="stable").tolist():
        at, members = end, []
        while at >= 0 and not used[at]:
            members.append(at)
            used[at] = True
            at = int(before[at])
        if members and members[0] == end:
            out.append((float(score[end] - (score[at] if at >= 0 else 0.0)), members[::-1]))
    return out


def candidates(length: int, seeds: list[dict], k: int, max_places: int = MAX_PLACES) -> list[dict]:
    """The best chains of a read of that length, from its seeds (position, flipped, n, places)."""
    rare = [s for s in seeds if s["n"] <= max_places]
    if not rare:
        least = min((s["n"] for s in seeds), default=0)
        rare = [s for s in seeds if s["n"] == least]
    anchors = sorted({(p["reference"], p["flipped"] != s["flipped"], p["position"], length - k - s["position"] if p["flipped"] != s["flipped"] else s["position"]) for s in rare for p in s["places"]})
    out = []
    for (reference, reverse), group in groupby(anchors, lambda a: a[:2]):
        r, q = np.array([a[2:] for a in group], np.int64).T
        for score, members in chained(r, q, k):
            diagonals = (r - q)[members]
            out.append({"reference": reference, "reverse": reverse, "chain": score, "anchors": len(members), "first": int(q[members[0]]), "last": int(q[members[-1]]) + k, "low": int(diagonals.min()), "high": int(diagonals.max()), "unique": rare[0]["n"] <= max_places})
    out.sort(key=lambda c: (-c["chain"], c["reference"], c["low"], c["reverse"]))
    return out[:CANDIDATES]


# Alignments


def banded(reads: list[bytes], windows: list[bytes], width: int) -> list[tuple[int, int, str, int]]:
    """(score, start in the window, CIGAR, edit distance) of reads against windows, cell (i, d) pairing base i of a read with base i + d of its window, 0 <= d < width.

    Each read may begin and end anywhere; what is clipped costs END_BONUS an end. Dashes at a window's start stand before the reference, where nothing pairs. All
    reads go through the rows of the table together.
    """
    n, longest = len(reads), max(map(len, reads))
    a, b = np.zeros((n, longest), np.uint8), np.ones((n, longest + width), np.uint8)
    for x, (read, window) in enumerate(zip(reads, windows)):
        a[x, : len(read)] = np.frombuffer(read, np.uint8)
        b[x, : min(len(window), longest + width)] = np.frombuffer(window, np.uint8)[: longest + width]
    sizes, ends = np.array([len(x) for x in reads]), np.array([len(x) for x in windows])[:, None]
    leads = np.array([len(x) - len(x.lstrip(b"-")) for x in windows])[:, None]
    d = np.arange(width)
    # h, up, left: best score of an alignment that ends in the cell, with a base of the read alone, with one of the window alone.
    h, up, left = (np.full((longest + 1, n, width), NEVER, np.int32) for _ in range(3))
    h[0] = np.where((d <= ends) & (d >= leads), 0, NEVER)
    slope = (EXTEND * d).astype(np.int32)
    for i in range(1, longest + 1):
        same = (a[:, i - 1, None] == b[:, i - 1 : i - 1 + width]) & (a[:, i - 1, None] != 78)
        has_base, inside = (i + d <= ends) & (i + d > leads), (i + d <= ends) & (i + d >= leads)
        best = np.where(has_base, h[i - 1] + np.where(same, MATCH, -MISMATCH), NEVER)
        up[i, :, :-1] = np.maximum(h[i - 1, :, 1:] - OPEN, up[i - 1, :, 1:]) - EXTEND
        best = np.maximum(best, np.where(inside, up[i], NEVER))
        best = np.maximum(best, np.where(inside, -END_BONUS, NEVER))
        left[i, :, 1:] = np.maximum.accumulate(best + slope, 1)[:, :-1] - OPEN - slope[1:]
        left[i] = np.where(has_base, left[i], NEVER)
        h[i] = np.maximum(best, left[i])
    return [_traced(h[:, x], up[:, x], left[:, x], reads[x], windows[x]) for x in range(n)] if sizes.any() else [(0, 0, "", 0)] * n


def _traced(h: np.ndarray, up: np.ndarray, left: np.ndarray, read: bytes, window: bytes) -> tuple[int, int, str, int]:
    size, lead = len(read), len(window) - len(window.lstrip(b"-"))
    final = h[: size + 1].max(1) - np.where(np.arange(size + 1) < size, END_BONUS, 0)
    i = size - int(final[::-1].argmax())  # the longest of equals
    d, score = int(h[i].argmax()), int(final[i])
    steps, edits, state = ["S"] * (size - i), 0, "M"
    while True:
        if state == "M":
            value = h[i, d]
            if i == 0:
                break
            if lead < i + d <= len(window) and value == h[i - 1, d] + (MATCH if read[i - 1] == window[i - 1 + d] and read[i - 1] != 78 else -MISMATCH):
                edits += read[i - 1] != window[i - 1 + d] or read[i - 1] == 78
                steps.append("M")
                i -= 1
            elif value == -END_BONUS:
                break
            else:
                state = "I" if value == up[i, d] else "D"
        elif state == "I":
            steps.append("I")
            edits += 1
            opened = up[i, d] == h[i - 1, d + 1] - OPEN - EXTEND
            i, d = i - 1, d + 1
            state = "M" if opened else "I"
        else:
            steps.append("D")
            edits += 1
            opened = left[i, d] == h[i, d - 1] - OPEN - EXTEND
            d -= 1
            state = "M" if opened else "D"
    steps += ["S"] * i
    return score, i + d, "".join(f"{len(list(run))}{op}" for op, run in groupby(reversed(steps))), int(edits)


# Spark


_CHAIN = "read_id string, ordinal long, sequence string, c int, reference string, reverse boolean, chain double, anchors int, first int, last int, low long, pad int, unique boolean"
_ALIGNED = "read_id string, ordinal long, sequence string, reference string, reverse boolean, chain double, anchors int, first int, last int, unique boolean, start long, cigar string, nm int, score int"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])


def _chains(k: int, max_places: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(_CHAIN)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                read = row["sequence"]
                for c, found in enumerate(candidates(len(read), row["seeds"], k, max_places)):
                    pad = PAD + found["high"] - found["low"]
                    out.append({"read_id": row["read_id"], "ordinal": row["ordinal"], "c": c, "sequence": read.translate(COMPLEMENT)[::-1] if found["reverse"] else read, "pad": pad} | found)
            yield pa.RecordBatch.from_pylist(out, schema)

    return each


def _plain(row: dict) -> tuple[int, int, str, int] | None:
    """The alignment along a chain without gaps where it has one mismatch at most: a gap or a clip would score less than that."""
    read, window = row["sequence"].encode(), row["window"][PAD : PAD + len(row["sequence"])].encode()
    if row["pad"] > PAD or len(window) < len(read) or b"-" in window:
        return None
    if read == window and b"N" not in read:
        edits = 0
    else:
        a = np.frombuffer(read, np.uint8)
        edits = int(((a != np.frombuffer(window, np.uint8)) | (a == 78)).sum())
    return (MATCH * len(read) - edits * (MATCH + MISMATCH), PAD, f"{len(read)}M", edits) if edits <= 1 else None


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(_ALIGNED)
    for batch in batches:
        rows, out, at = [], [], 0

        def add(r: dict, score: int, start: int, cigar: str, edits: int) -> None:
            if score > 0:
                out.append({name: r[name] for name in ("read_id", "ordinal", "sequence", "reference", "reverse", "chain", "anchors", "first", "last", "unique")} | {"start": r["origin"] + start, "cigar": cigar, "nm": edits, "score": score})

        for r in batch.to_pylist():
            if found := _plain(r):
                add(r, *found)
            else:
                rows.append(r)
        rows.sort(key=lambda r: (r["pad"], len(r["sequence"])))
        while at < len(rows):
            pad, end = rows[at]["pad"], at
            while end < len(rows) and rows[end]["pad"] == pad and (end == at or (end - at + 1) * len(rows[end]["sequence"]) * (2 * pad + 1) <= CELLS):
                end += 1
            some = rows[at:end]
            found = banded([r["sequence"].encode() for r in some], [r["window"].encode() for r in some], 2 * pad + 1)
            for r, x in zip(some, found):
                add(r, *x)
            at = end
        yield pa.RecordBatch.from_pylist(out, schema)


def of_few_sequences(reads: DataFrame) -> bool:
    """Whether the alignments of all different sequences may be broadcast. Counts them in one scan, without a shuffle: for stored reads."""
    n, longest = reads.agg(F.approx_count_distinct("sequence"), F.max(F.length("sequence"))).first()
    return n * (2 * (longest or 0) + 200) <= SMALL_FOUND


def align(reads: DataFrame, index: Index, max_places: int = MAX_PLACES, few: bool = False) -> DataFrame:
    """read_id, ordinal, sequence (as it lies on the reference), reference_name, reference_start (0-based), reverse, cigar, mismatches (edit distance), score and mapq: a row for each read that aligns.

    few: of_few_sequences(reads), if that was asked.
    """
    own = reads.where("read_id IS NOT NULL AND ordinal IS NOT NULL").select("read_id", F.col("ordinal").cast("long").alias("ordinal"), F.upper("sequence").alias("sequence"))
    # An alignment depends on the bases alone: each sequence is aligned once, named by its digest, and all reads of it take what was found.
    digest = F.md5("sequence")
    each = own.where(F.length("sequence") >= index.k).groupBy("sequence").agg(F.count("*").alias("_n"))  # by hash: no sort of all reads
    each = each.select(F.when(F.col("_n") > 0, digest).alias("read_id"), F.lit(0).cast("long").alias("ordinal"), "sequence")
    found = _aligned(each, index, max_places).withColumn("_bases", F.unhex("read_id")).drop("read_id", "ordinal")
    return own.select("read_id", "ordinal", F.unhex(digest).alias("_bases")).join(met(found, few), "_bases").drop("_bases")


def _aligned(own: DataFrame, index: Index, max_places: int) -> DataFrame:
    probes = minimizers(own, "read_id", "ordinal", k=index.k, w=index.w).withColumn("position", F.col("position").cast("long"))
    seeds = probes.join(met(index.seeds, index.small), "v").groupBy("read_id", "ordinal").agg(F.collect_list(F.struct("position", "flipped", "n", "places")).alias("seeds"))
    chains = own.join(met(seeds, False), ["read_id", "ordinal"]).select("read_id", "ordinal", "sequence", "seeds").mapInArrow(_chains(index.k, max_places), _CHAIN)
    # The window starts a band's half-width before the chain's lowest diagonal.
    lowest, length = F.col("low") - PAD, F.length("sequence")
    start = F.greatest(lowest, F.lit(0).cast("long"))
    stop = F.greatest(F.col("low") + length + F.col("pad"), start + 1)
    number = lambda at: F.floor(at / BASES).cast("int")
    covered = chains.withColumns({"origin": lowest, "start": start, "stop": stop}).withColumn("piece", F.explode(F.sequence(number(F.col("start")), number(F.col("stop") - 1))))
    names = [c for c in chains.columns if c != "low"] + ["origin", "start", "stop"]
    joined = covered.join(met(index.bases, index.small), ["reference", "piece"]).groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("piece", "bases"))).alias("_x"))
    offset = F.col("start") - F.get("_x", F.lit(0))["piece"].cast("long") * BASES
    bases = F.substring(F.array_join(F.transform("_x", lambda x: x["bases"]), ""), (offset + 1).cast("int"), (F.col("stop") - F.col("start")).cast("int"))
    window = F.concat(F.repeat(F.lit("-"), (F.col("start") - F.col("origin")).cast("int")), bases)
    aligned = joined.select(*names, window.alias("window")).mapInArrow(_extended, _ALIGNED)
    best = aligned.groupBy("read_id", "ordinal").agg(F.min_by(F.struct("*"), F.struct((-F.col("score")).alias("s"), "reference", "start", "reverse")).alias("b"), F.collect_list(F.struct("score", "first", "last", "reference", "start", "reverse")).alias("all"))
    # mapq = 40 (1 - rival / score) min(1, anchors / 10) ln(chain), from 0 to 60. Rivals are alignments elsewhere whose chains cover half of the best one's part of the read.
    b = F.col("b")
    overlap = lambda x: F.least(x["last"], b["last"]) - F.greatest(x["first"], b["first"])
    other = lambda x: (x["reference"] != b["reference"]) | (x["reverse"] != b["reverse"]) | (F.abs(x["start"] - b["start"]) > PAD)
    rivals = F.filter("all", lambda x: other(x) & (2 * overlap(x) >= b["last"] - b["first"]))
    rival = F.coalesce(F.array_max(F.transform(rivals, lambda x: x["score"])), F.lit(0))
    quality = F.round(40 * (1 - rival / b["score"]) * F.least(F.lit(1.0), b["anchors"] / 10) * F.log(F.greatest(b["chain"], F.lit(1.0)))).cast("int")
    quality = F.when(b["unique"], F.greatest(F.lit(0), F.least(F.lit(60), quality))).otherwise(F.lit(0))
    return best.select("read_id", "ordinal", "b.sequence", F.col("b.reference").alias("reference_name"), F.col("b.start").alias("reference_start"), "b.reverse", "b.cigar", F.col("b.nm").alias("mismatches"), "b.score", quality.alias("mapq"))
