"""Document fingerprints: homomorphic multiset hashes of paragraphs.

A paragraph is what stands between line ends. Each is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs' vectors: the first EXACT numbers
modulo 2^64, from the paragraph as a whole, and SKETCH numbers modulo 2^32, to which each run of GRAM characters inside the paragraph (or a shorter paragraph as
a whole) adds or subtracts one at a place that its hash names. So a fingerprint doesn't depend on the paragraphs' order, repeats count, and a paragraph is
inserted or deleted by adding or subtracting its vector; sums of fingerprints are fingerprints of the documents together.

Equal fingerprints mean equal multisets of paragraphs, but for chance (512 bits; it is no defence against forgers). `likeness` is 1 for those. Else it
is the share of runs that two documents have in common: the squares of the sketch's numbers sum up, on average, to the squares of the runs' numbers of occurrences,
for a difference of fingerprints as well, so 1 - |a - b|^2 / (|a|^2 + |b|^2) needs the fingerprints alone. With 192 numbers it is off by some 0.07.

`with_next` orders documents by id and pairs each with the one after it. Texts are shuffled once, into slots of consecutive keys (id, then the hash of the text) of about the same
number of characters; each slot gets the first document of the next one too. Bounds of slots come from a sample of keys, a bounded number for each
slot, on which only the balance depends.

Defined cases: a null text is an empty one, whose fingerprint is that of one empty paragraph; null ids come first; rows that repeat id and text are one document in
the order, each with its own row in the result, and are spread over tasks if there are many; texts that share an id follow each other by hash; the last document is followed by the
first, a single one by itself; an empty table gives an empty result; other columns are ignored. Texts of any length are whole.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from germlight.llm._shared import Scratch, let, table

EXACT, SKETCH, GRAM = 8, 192, 12
#: Characters that are hashed, and rows that are returned, at a time.
CHUNK, ROWS = 1 << 20, 256
#: Slots for each shuffle partition, sampled keys for each slot, and occurrences in the sample from which a key gets slots of its own.
SLOTS, SAMPLE, HEAVY = 2, 32, 16
MULTIPLIER, MIXER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def paragraphs(text: str) -> list[str]:
    return text.split("\n")


def _signed(hashes: np.ndarray) -> np.ndarray:
    """For each place of the sketch, how many hashes add one less how many subtract one."""
    votes = np.bincount((hashes % np.uint64(SKETCH)).astype(np.int64) * 2 + (hashes >> np.uint64(63)).astype(np.int64), minlength=2 * SKETCH)
    return votes[1::2] - votes[::2]


class Fingerprint:
    """A multiset of paragraphs as one sum."""

    def __init__(self, exact: np.ndarray | None = None, sketch: np.ndarray | None = None):
        self.exact = np.zeros(EXACT, np.uint64) if exact is None else exact
        self.sketch = np.zeros(SKETCH, np.uint32) if sketch is None else sketch

    @classmethod
    def of(cls, parts: list[str]) -> Fingerprint:
        if not parts:
            return cls()
        digests = np.frombuffer(b"".join(hashlib.blake2b(p.encode(errors="replace"), digest_size=8 * EXACT).digest() for p in parts), "<u8").reshape(-1, EXACT)
        sketch = _signed(digests[[0 < len(p) < GRAM for p in parts], 0])
        whole = "\n".join(p for p in parts if len(p) >= GRAM)
        for at in range(0, len(whole) - GRAM + 1, CHUNK):
            codes = np.frombuffer(whole[at : at + CHUNK + GRAM - 1].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
            n = len(codes) - GRAM + 1
            h = codes[:n].copy()
            for j in range(1, GRAM):
                h *= MULTIPLIER
                h += codes[j : j + n]
            ends = np.concatenate([[0], np.cumsum(codes == 10)])
            h = h[ends[GRAM:] == ends[:n]]  # runs inside a paragraph
            h = (h ^ h >> np.uint64(32)) * MIXER
            h = (h ^ h >> np.uint64(32)) * MIXER
            sketch = sketch + _signed(h ^ h >> np.uint64(32))
        return cls(digests.sum(0, dtype=np.uint64), sketch.astype(np.uint32))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.sketch + other.sketch)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.sketch - other.sketch)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and str(self) == str(other)

    __hash__ = None

    def edited(self, before: list[str], after: list[str]) -> Fingerprint:
        """That of the document with paragraphs `after` in the place of `before`; others aren't hashed again."""
        return self - self.of(before) + self.of(after)

    def size(self) -> float:
        return float(np.square(self.sketch.astype(np.int32).astype(np.float64)).sum())

    def likeness(self, other: Fingerprint) -> float:
        if self == other:
            return 1.0
        both = self.size() + other.size()
        return min(1.0, max(0.0, 1 - (self - other).size() / both)) if both else 0.0

    def __str__(self) -> str:
        return base64.b64encode(self.exact.astype("<u8").tobytes() + self.sketch.astype("<u4").tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        data = base64.b64decode(text)
        return cls(np.frombuffer(data, "<u8", EXACT).astype(np.uint64), np.frombuffer(data, "<u4", SKETCH, 8 * EXACT).astype(np.uint32))


def _shared_head(a: list[str], b: list[str]) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def edit(text: str, following: str) -> str:
    """text with its last half, rounded down, replaced by as much of the start of following as there is."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint of every row; a narrow plan."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [str(Fingerprint.of(paragraphs(t.as_py() or ""))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=[id_col, "fingerprint"])

    own = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return own.mapInArrow(each, f"`{id_col}` {own.schema[id_col].dataType.simpleString()}, fingerprint string")


def _slot_of(bounds: list[tuple]) -> Column:
    """How many bounds are at most (known, id, h); a binary search of a constant array."""
    if not bounds:
        return F.lit(0)
    rows = json.dumps([{"known": a, "id": b, "h": c} for a, b, c in bounds])
    bits = len(bounds).bit_length()
    key = F.struct("known", "id", "h")

    def step(array: Column, found: Column, bit: Column) -> Column:
        return F.when((found + bit <= len(bounds)) & (F.get(array, found + bit - 1) <= key), found + bit).otherwise(found)

    return let(F.from_json(F.lit(rows), "array<struct<known: boolean, id: bigint, h: bigint>>"), lambda array: F.aggregate(F.array(*(F.lit(1 << b) for b in reversed(range(bits)))), F.lit(0), lambda found, bit: step(array, found, bit)))


def _after(key: tuple) -> tuple:
    known, id_, h = key
    return (known, id_, h + 1) if h < 2**63 - 1 else (known, id_ + 1, -(2**63))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame | None:
    """Rows (slot, part, guard, known, id, h, text), each (slot, part) sorted in one partition: all documents, and after those of each slot the first one of the next, as a guard. None for no rows."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).isNotNull().alias("known"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    keys = Scratch(spark, "order").keep(own.select("known", "id", "h", F.length("text").alias("n")))
    total = keys.count()
    if not total:
        return None
    slots = SLOTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sample = sorted(map(tuple, keys.sample(min(1.0, SAMPLE * slots / total), 1).collect()))  # SAMPLE short rows a slot
    sizes = np.cumsum([n + 64 for *_, n in sample])
    cuts = np.searchsorted(sizes, sizes[-1] * np.arange(1, slots) / slots) if sample else []
    heavy = {k for k, n in Counter(s[:3] for s in sample).items() if n >= HEAVY}
    bounds = sorted({sample[i][:3] for i in cuts if i < len(sample)} | heavy | set(map(_after, heavy)))
    slot = _slot_of(bounds)
    heads = keys.select(slot.alias("slot"), F.struct("known", "id", "h").alias("key")).groupBy("slot").agg(F.min("key").alias("key"), F.count("*").alias("rows")).orderBy("slot").collect()  # a row a slot
    # A slot of one key with many rows is dealt out in parts: all its rows are alike.
    parts = {r["slot"]: max(1, -(-r["rows"] * slots // total)) if tuple(r["key"]) in heavy else 1 for r in heads}
    guards = [(*map(int, (heads[i - 1]["slot"], parts[heads[i - 1]["slot"]])), *r["key"]) for i, r in enumerate(heads)]
    of_head = F.broadcast(spark.createDataFrame(guards, "slot int, parts int, known boolean, id long, h long"))
    texts = own.join(of_head, ["known", "id", "h"]).groupBy("slot", "parts", "known", "id", "h").agg(F.first("text").alias("text"))
    guard_rows = texts.select("slot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("guard"), "known", "id", "h", "text")
    several = {s: n for s, n in parts.items() if n > 1}
    n_parts = F.coalesce(F.get(F.from_json(F.lit(json.dumps([parts.get(s, 1) for s in range(len(bounds) + 1)])), "array<int>"), F.col("slot")), F.lit(1)) if several else F.lit(1)
    rows = own.withColumn("slot", slot).withColumn("part", F.floor(F.rand(1) * n_parts).cast("int") if several else F.lit(0)).select("slot", "part", F.lit(False).alias("guard"), "known", "id", "h", "text")
    return rows.unionByName(guard_rows).repartition("slot", "part").sortWithinPartitions("slot", "part", "guard", "known", "id", "h")


OUTPUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """OUTPUT for every row of docs: its fingerprint, that of its edited text (found by deleting and inserting paragraphs), and their likeness."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [x.split()[0] for x in OUTPUT.split(", ")], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        out, last, times = [], None, 0  # the document that waits for its next one, and how many rows are like it

        def done(text: str, own: Fingerprint, doc_id: int | None, following: str, next_: Fingerprint) -> tuple:
            changed = edit(text, following)
            before, after = paragraphs(text), paragraphs(changed)
            same = _shared_head(before, after)
            new = own.edited(before[same:], after[same:])
            return doc_id, len(text), hashlib.sha256(changed.encode(errors="replace")).hexdigest(), str(own), str(new), own.likeness(new), own.likeness(next_)

        def flush() -> pa.RecordBatch:
            columns = zip(*out) if out else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            slots, parts, guards, knowns, ids, hashes, texts = batch.columns
            for i in range(batch.num_rows):
                key = knowns[i].as_py(), ids[i].as_py(), hashes[i].as_py()
                guard = guards[i].as_py()
                if last is not None and not guard and key == last[0]:
                    times += 1
                    continue
                text = texts[i].as_py()
                own = last[3] if last is not None and key == last[0] else Fingerprint.of(paragraphs(text))
                if last is not None:
                    row = done(last[2], last[3], last[1], text, own)
                    for _ in range(times):
                        out.append(row)
                        if len(out) == ROWS:
                            yield flush()
                            out.clear()
                last, times = (None, 0) if guard else ((key, key[1] if key[0] else None, text, own), 1)
        yield flush()

    rows = with_next(docs, id_col, text_col)
    return docs.sparkSession.createDataFrame([], OUTPUT) if rows is None else rows.mapInArrow(each, OUTPUT)


def op12_multiset_hash(spark, sf_dir: str) -> DataFrame:
    return edits(table(spark, sf_dir, "documents"))
