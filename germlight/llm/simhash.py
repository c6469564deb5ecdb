"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint becomes a vector of 32 counts, the set bits of each 2-bit segment. The Manhattan distance of two vectors is never more than the
Hamming distance of the fingerprints, so fingerprints within 4 bits have vectors within 4, and in one of the two 16-segment bands within 2. That
is a range join on a grid: two lattice points within 2 have a common lattice point within 1 of both, so each fingerprint visits its own cell and the
adjacent ones (25 on average, in each band), and all pairs within range meet in a cell. In a cell they are verified exactly (xor and popcount) and
reported as a forest, one edge for each member at most, never as all pairs. Cells that may be crowded are divided again by the same grid over the
halves of the other band, which must be within 4 too; in what stays crowded, points are compared by way of pivots.

For near copies that are further apart, `near_duplicates(similar=True)` adds every pair of texts whose sets of 5-word shingles have a Jaccard similarity of 0.8
or more, by a prefix filter: in one order of all shingles such sets share one of their first n - ceil(0.8 n) + 1. Shingles that a sample finds common come
last in that order (which shingles these are changes the work, never the pairs). Pairs that meet, but those whose sketches differ too much, are verified on the
whole sets: first the likeliest pair of each text, among those with its neighbour and the first in every shingle's group, then all pairs that aren't connected
by then, so that a group of near copies isn't formed as all pairs.

Only distinct fingerprints take part, so a group of exact copies is one point whatever its size. Components come from alternating star
contractions, each round written to the shared folder.

Defined cases: a null or empty text, or one without words, has fingerprint zero and links like any other; repeated rows and ties share a
fingerprint and so a component, whose id is the smallest non-null doc_id (null if there is none); an empty table gives an empty result; columns other
than the named ones are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from germlight.llm._shared import Scratch, bounded_broadcast, release_memory, table

SEED, SHINGLE, MAX_DISTANCE = 42, 4, 4
#: Members from which a cell is divided again, and rows up to which the list of such cells is broadcast.
CROWDED, BROADCAST_ROWS = 4096, 200_000
#: Cells that a fingerprint visits in one band at most (each of 16 segments up and down, and its own).
VISITED = 33
#: Members up to which all pairs of a cell are compared, and comparisons at a time in larger ones.
SMALL, COMPARED = 256, 1 << 21
#: Members of a component from which its rows are dealt out apart, and such components up to which their list is broadcast.
LARGE, BROADCAST_LARGE = 1000, 200_000
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16

#: The other definition of near copies: words of a shingle, and least Jaccard similarity as a fraction.
SIMILAR_SHINGLE, SIMILAR = 5, (4, 5)
#: For the order of shingles only: one text of so many is sampled; texts of the sample that make a shingle common; common ones that are kept.
SAMPLED, COMMON, MAX_COMMON = 16, 3, 200_000
#: Candidate pairs that a task gathers before it hands them on, and texts whose shingles it has at a time.
PAIRS, TEXTS = 1 << 18, 256

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "replace").translate(_LOWER))


def fingerprint_of(text: str | None, size: int = SHINGLE) -> int:
    """The unsigned fingerprint of one whole text."""
    import xxhash

    words = _words(text)
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < size:
        return digest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], ends[at : at + BLOCK])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * counts > len(starts)).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint as a long (two's complement)."""

    @F.arrow_udf("long")
    def each(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint_of(t.as_py(), size) for t in texts], np.uint64).view(np.int64))

    return each(text)


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


#: Counts of each 2-bit segment, side by side: 0, 1 or 2 in each pair of bits.
_COUNTS = "(shiftleft(fp & shiftrightunsigned(fp, 1) & 6148914691236517205L, 1) | ((fp ^ shiftrightunsigned(fp, 1)) & 6148914691236517205L))"


def _visited(cell: str, segments: int) -> str:
    """SQL for the array of lattice points within 1 of a packed vector of counts."""
    step = "transform(sequence(0, {n}), i -> IF((shiftright({c}, 2 * i) & 3) {test}, {c} {sign} shiftleft(1L, 2 * i), NULL))"
    parts = ", ".join(step.format(n=segments - 1, c=cell, test=test, sign=sign) for test, sign in (("< 2", "+"), ("> 0", "-")))
    return f"filter(concat(array({cell}), {parts}), z -> z IS NOT NULL)"


def _grid(fps: DataFrame, crowded: int, scratch: Scratch) -> DataFrame:
    """(cell, part, fp): every cell that a fingerprint visits. The band is in the cell's bits from 32 on; part is 0 but in crowded cells."""
    bands = fps.selectExpr("fp", f"{_COUNTS} AS counts").selectExpr("fp", "explode(array(struct(counts & 4294967295L AS own, shiftrightunsigned(counts, 32) AS other, 0L AS band), struct(shiftrightunsigned(counts, 32) AS own, counts & 4294967295L AS other, 1L AS band))) AS b")
    bands = bands.select("fp", "b.own", "b.other", "b.band")
    # A cell of CROWDED members has a neighbour in which at least CROWDED / VISITED live.
    heavy = bands.groupBy("band", "own").count().where(F.col("count") >= max(2, crowded // VISITED))
    heavy = scratch.keep(heavy.selectExpr(f"explode(transform({_visited('own', 16)}, z -> shiftleft(band, 32) | z)) AS cell").distinct().withColumn("heavy", F.lit(True)))
    rows = bands.selectExpr("fp", "other", f"explode(transform({_visited('own', 16)}, z -> shiftleft(band, 32) | z)) AS cell")
    rows = rows.join(bounded_broadcast(heavy, BROADCAST_ROWS), "cell", "left")
    low, high = "(other & 65535L)", "shiftrightunsigned(other, 16)"
    finer = f"concat(transform({_visited(low, 8)}, z -> 65536L | z), transform({_visited(high, 8)}, z -> 131072L | z))"
    return rows.selectExpr("cell", f"explode(IF(heavy, {finer}, array(0L))) AS part", "fp")


def _forest(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Each point's smallest connected point, once a and b are connected with all that they are connected with in root."""
    root = root.copy()
    while True:
        x, y = root[a], root[b]
        if (same := x == y).all():
            return root
        x, y = x[~same], y[~same]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != (up := root[root])).any():
            root = up


def _crowd(fp: np.ndarray, distance: int) -> np.ndarray:
    """Each point's smallest connected point, in a cell of many points.

    Balls around pivots take the points first; two pivots are never near. A point that is near one of another ball is within twice the distance of that
    ball's pivot, and only points that aren't connected by then are compared, so a cell of near copies costs its size times its few balls.
    """
    root, rest, balls = np.arange(len(fp)), np.arange(len(fp)), []
    while len(rest):
        near = np.bitwise_count(fp[rest] ^ fp[rest[0]]) <= distance
        if (ball := rest[near]).size > 1:
            balls.append(ball)
            root[ball] = ball[0]
        rest = rest[~near]
    for ball in balls:
        others = np.flatnonzero(np.bitwise_count(fp ^ fp[ball[0]]) <= 2 * distance)
        step = at = 0
        while len(others := others[root[others] != root[ball[0]]]) and at < len(ball):
            step = max(1, COMPARED // len(others))
            part = fp[ball[at : at + step]]
            met = (np.bitwise_count(part[:, None] ^ fp[others]) <= distance).any(axis=0)
            if met.any():
                joined = np.unique(np.append(root[others[met]], root[ball[0]]))
                root[np.isin(root, joined)] = joined[0]
            at += step
    return root


def _verified(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges (larger, smaller) of rows sorted by key: pairs in one key within distance. Memory follows the rows, not the pairs."""
    n = len(fp)
    ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, n)
    starts = np.append(0, ends[:-1])
    sizes = ends - starts
    last, root, left, right, d = np.repeat(ends, sizes), np.arange(n), [], [], 1
    active = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    while len(active := active[active + d < last[active]]):
        near = active[np.bitwise_count(fp[active] ^ fp[active + d]) <= distance]
        left.append(near), right.append(near + d)
        if sum(map(len, left)) > n:
            root, left, right = _forest(root, np.concatenate(left), np.concatenate(right)), [], []
        d += 1
    if left:
        root = _forest(root, np.concatenate(left), np.concatenate(right))
    for i, j in zip(starts[sizes > SMALL].tolist(), ends[sizes > SMALL].tolist()):
        root[i:j] = i + _crowd(fp[i:j], distance)
    own = np.flatnonzero(root != np.arange(n))
    return fp[own], fp[root[own]]


def links(fps: DataFrame, distance: int = MAX_DISTANCE, crowded: int = CROWDED, scratch: Scratch | None = None) -> DataFrame:
    """(a, b) with a > b: edges that connect exactly what pairs of distinct fingerprints (column fp) within distance connect. Distances up to 4."""
    if not 0 <= distance <= 4:
        raise ValueError("the grid covers distances up to 4")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_key, rest_fp = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64)

        def out(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            change = (key[1:] != key[:-1]).any(axis=1)
            ids = np.concatenate([[0], np.cumsum(change)]) if len(key) else np.zeros(0, np.int64)
            x, y = _verified(ids, fp, distance)
            x, y = x.view(np.int64), y.view(np.int64)
            if len(x):
                pairs = np.unique(np.stack([np.maximum(x, y), np.minimum(x, y)], axis=1), axis=0)
                pairs = pairs[pairs[:, 0] != pairs[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            key = np.concatenate([rest_key, np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)])
            fp = np.concatenate([rest_fp, batch.column(2).to_numpy().view(np.uint64)])
            if not len(key):
                continue
            whole = len(key) - int((key == key[-1]).all(axis=1)[::-1].argmin()) if (key != key[-1]).any() else 0  # the last cell may go on
            rest_key, rest_fp = key[whole:], fp[whole:]
            yield from out(key[:whole], fp[:whole])
        yield from out(rest_key, rest_fp)

    grid = _grid(fps.select("fp"), crowded, scratch or Scratch(fps.sparkSession, "links")).repartition("cell", "part").sortWithinPartitions("cell", "part", "fp")
    return grid.mapInArrow(meet, "a long, b long").distinct()


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(a, b): every node of edges (a, b) but the smallest of its component, with that smallest."""
    scratch = scratch or Scratch(edges.sparkSession, "components")
    edges, before = scratch.keep(edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a <> b").distinct()), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges
        before = now
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = scratch.keep(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size")).selectExpr("u", "least(u, m) AS m", "size"))
        large = _by_key(both.where("v > u"), least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        old, edges = edges, scratch.keep(small.where("a <> b").distinct())
        scratch.drop(old, least)


def _by_key(rows: DataFrame, of_key: DataFrame, key: str) -> DataFrame:
    """rows joined with of_key, which has one row a key and the `size` of it among rows: rows of large keys by a list of those, not dealt out by the key."""
    large = bounded_broadcast(of_key.where(F.col("size") >= LARGE).drop("size"), BROADCAST_LARGE)
    others = rows.join(large.select(key), key, "left_anti").join(of_key.where(F.col("size") < LARGE).drop("size"), key)
    return rows.join(large, key).unionByName(others)


def shingles_of(text: str | None, size: int = SIMILAR_SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles of one whole text, ascending; a shorter text is one shingle."""
    import xxhash

    words = _words(text)
    digest = xxhash.xxh64_intdigest
    grams = (b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else ()
    return np.unique(np.fromiter((digest(g, SEED) for g in grams), np.uint64).view(np.int64))


def _of_texts(texts: DataFrame, body, schema: str) -> DataFrame:
    """body([(h, shingles), ...]) of TEXTS texts at a time. A task takes each of its texts once."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            some = []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if h not in seen:
                    seen.add(h)
                    some.append((h, shingles_of(text.as_py())))
                if len(some) >= TEXTS:
                    yield body(some)
                    some = []
            if some:
                yield body(some)
        release_memory()

    return texts.select("h", "text").mapInArrow(each, schema)


def _each_shingle(some: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([x for _, x in some]))], names=["s"])


def _sketch(some: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Number of shingles, and how many have each value of their hash's low byte (255 at most): the counts of two sets differ by no more than the sets do."""
    counts = [np.minimum(np.bincount(x & 255, minlength=256), 255).astype(np.uint8).tobytes() for _, x in some]
    return pa.RecordBatch.from_arrays([pa.array([h for h, _ in some], pa.int64()), pa.array([len(x) for _, x in some], pa.int64()), pa.array(counts, pa.binary())], names=["h", "n", "counts"])


def _apart(x: Column, y: Column) -> Column:
    """By how much the counts of two sketches differ."""

    @F.arrow_udf("long")
    def each(x: pa.Array, y: pa.Array) -> pa.Array:
        own = [np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, 256).astype(np.int16) for c in (x, y)]
        return pa.array(np.abs(own[0] - own[1]).sum(1, dtype=np.int64))

    # Otherwise a filter on it would have it computed twice, in workers of its own.
    return each.asNondeterministic()(x, y)


def _may_be_similar(n: Column, apart: Column) -> Column:
    """Whether sets that have n shingles together and differ in `apart` or more allow the similarity: (1 - J) / (1 + J) of n may differ."""
    return (SIMILAR[0] + SIMILAR[1]) * apart <= (SIMILAR[1] - SIMILAR[0]) * n


def _prefixes(texts: DataFrame, common: np.ndarray) -> DataFrame:
    """(s, n, h, i): text h of n shingles has s in place i of its prefix. common is ascending."""

    def body(some: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        parts = [(np.zeros(0, np.int64),) * 4]
        for h, own in some:
            n = len(own)
            if len(common) and n:
                late = common[np.minimum(np.searchsorted(common, own), len(common) - 1)] == own
                own = np.concatenate([own[~late], own[late]])
            if n:
                first = own[: n - -(-SIMILAR[0] * n // SIMILAR[1]) + 1]
                parts.append((first, np.full(len(first), n), np.full(len(first), h), np.arange(len(first))))
        s, n, h, i = (np.concatenate(x) for x in zip(*parts))
        return pa.RecordBatch.from_arrays([pa.array(s), pa.array(n, pa.int32()), pa.array(h, pa.int64()), pa.array(i, pa.int32())], names=["s", "n", "h", "i"])

    return _of_texts(texts, body, "s long, n int, h long, i int")


def _by_shingle(rows: DataFrame, body, schema: str) -> DataFrame:
    """body(columns) over whole groups of rows with one s, sorted by s, n and h."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            own = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            own = own if rest is None else [np.concatenate(x) for x in zip(rest, own)]
            whole = int(np.searchsorted(own[0], own[0][-1])) if len(own[0]) else 0  # the last group may go on
            rest = [c[whole:].copy() for c in own]
            if whole:
                yield from body([c[:whole] for c in own])
        if rest is not None and len(rest[0]):
            yield from body(rest)
        release_memory()

    return rows.repartition("s").sortWithinPartitions("s", "n", "h").mapInArrow(each, schema)


def _shared(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of groups of two texts or more, each text once."""
    s, n, h, i = columns
    once = np.append(True, (s[1:] != s[:-1]) | (h[1:] != h[:-1]))
    s, n, h, i = (c[once] for c in columns)
    same = np.append(s[1:] == s[:-1], False)
    keep = same | np.append(False, same[:-1])
    if keep.any():
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (s, n, h, i)], names=["s", "n", "h", "i"])


def _candidates(every: bool):
    """Pairs of one group, of different roots, that sizes and places allow: all of them, or each row with the one before it and the group's first."""

    def body(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        s, n, h, i, root = columns
        n, i = n.astype(np.int64), i.astype(np.int64)
        start = np.append(0, np.flatnonzero(s[1:] != s[:-1]) + 1)
        group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(s))))
        mixed = np.logical_or.reduceat(root != root[start][group], start)[group]
        at, last = np.flatnonzero(mixed), np.append(start[1:], len(s))[group]
        found: list[np.ndarray] = []

        def allowed(x: np.ndarray, y: np.ndarray) -> None:
            ok = (root[x] != root[y]) & ((SIMILAR[0] + SIMILAR[1]) * np.minimum(n[x] - i[x], n[y] - i[y]) >= SIMILAR[0] * (n[x] + n[y]))
            found.append(np.stack([np.maximum(h[x], h[y])[ok], np.minimum(h[x], h[y])[ok]]))

        def out() -> Iterator[pa.RecordBatch]:
            if found:
                pairs = np.unique(np.concatenate(found, axis=1), axis=1)
                found.clear()
                if pairs.shape[1]:
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        if not every:
            allowed(at, start[group[at]])
        d = 1
        while len(at := at[at + d < last[at]]) and len(at := at[SIMILAR[1] * n[at] >= SIMILAR[0] * n[at + d]]):
            allowed(at, at + d)
            if sum(x.shape[1] for x in found) >= PAIRS:
                yield from out()
            if not every:
                break
            d += 1
        yield from out()

    return body


def _shares_enough(x: Column, y: Column) -> Column:
    """Whether the whole sets of shingles of texts x and y have the similarity."""

    @F.arrow_udf("boolean")
    def each(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for s, t in zip(x, y):  # one pair at a time leaves Arrow's memory
            s, t = shingles_of(s.as_py()), shingles_of(t.as_py())
            out.append((SIMILAR[0] + SIMILAR[1]) * len(np.intersect1d(s, t, assume_unique=True)) >= SIMILAR[0] * (len(s) + len(t)))
        release_memory()
        return pa.array(out, pa.bool_())

    return each(x, y)


def _similar(pairs: DataFrame, texts: DataFrame, best: bool, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of text hashes whose whole sets of shingles are similar enough; with best, only the likeliest pair of each text is asked."""

    def of(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        needed = scratch.keep(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct())
        return texts.join(bounded_broadcast(needed, BROADCAST_ROWS), "h", "left_semi"), needed

    # Most texts that meet share little: sketches of 256 bytes exclude them before whole texts move.
    met = scratch.keep(pairs.distinct())
    own, needed = of(met)
    sketches = scratch.keep(_of_texts(own, _sketch, "h long, n long, counts binary").dropDuplicates(["h"]))
    both = met.join(sketches.selectExpr("h AS a", "n AS m", "counts AS x"), "a").join(sketches.selectExpr("h AS b", "n", "counts AS y"), "b")
    apart = _apart(F.col("x"), F.col("y"))
    likely = scratch.keep(both.select("a", "b", (F.col("m") + F.col("n")).alias("n"), apart.alias("apart")).where(_may_be_similar(F.col("n"), F.col("apart"))))
    scratch.drop(met, needed, sketches)
    asked = likely.select("a", "b")
    if best:
        each = likely.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e"), (F.col("apart") / F.col("n")).alias("d"))
        nearest = each.groupBy("e.u").agg(F.min(F.struct("d", "e.v")).alias("x")).select("u", "x.v")
        asked = scratch.keep(nearest.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct())
    own, needed = of(asked)
    # Copies of a text in one task meet before they move.
    whole = own.groupBy("h").agg(F.first("text").alias("text"))
    both = asked.join(whole.select(F.col("h").alias("a"), F.col("text").alias("x")), "a").join(whole.select(F.col("h").alias("b"), F.col("text").alias("y")), "b")
    found = scratch.keep(both.where(_shares_enough(F.col("x"), F.col("y"))).select("a", "b"))
    scratch.drop(likely, needed, asked)
    return found


def similar_links(texts: DataFrame, prints: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) of fingerprints: edges, and those that connect with them what similar texts connect. texts: h, text; prints: h, fp of each h."""
    sample = _of_texts(texts.where(F.pmod("h", F.lit(SAMPLED)) == 0), _each_shingle, "s long")
    often = sample.groupBy("s").count().where(F.col("count") >= COMMON).orderBy(F.desc("count"), "s").limit(MAX_COMMON)
    common = np.array([r["s"] for r in often.collect()], np.int64)  # MAX_COMMON at most
    common.sort()
    shared = scratch.keep(_by_shingle(_prefixes(texts, common), _shared, "s long, n int, h long, i int"))
    for every in (False, True):
        stars = components(edges, scratch)
        roots = prints.join(stars.withColumnsRenamed({"a": "fp", "b": "root"}), "fp", "left").select("h", F.coalesce("root", "fp").alias("root"))
        pairs = _by_shingle(shared.join(roots, "h").select("s", "n", "h", "i", "root"), _candidates(every), "a long, b long")
        found = _similar(pairs, texts, not every, scratch)
        of = lambda c: prints.select(F.col("h").alias(c), F.col("fp").alias(f"fp_{c}"))  # noqa: B023, E731
        # Stars connect what edges do, in as many rows as they have nodes.
        old, edges = edges, scratch.keep(stars.unionByName(found.join(of("a"), "a").join(of("b"), "b").select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))))
        scratch.drop(old, stars, found)
    scratch.drop(shared)
    return edges


def _firsts(fps: DataFrame, stars: DataFrame, scratch: Scratch) -> DataFrame:
    """(fp, first): the least `lo` of each fingerprint's component. Rows of a large component are joined by a list of those, not dealt out by it."""
    members = scratch.keep(stars.select("a", "b").unionByName(stars.select(F.col("b").alias("a"), "b").distinct()).withColumnsRenamed({"a": "fp", "b": "root"}).join(fps, "fp"))
    of_root = scratch.keep(members.groupBy("root").agg(F.min("lo").alias("first"), F.count("*").alias("size")))
    linked = _by_key(members.select("fp", "root"), of_root, "root").select("fp", "first")
    return scratch.keep(fps.join(linked, "fp", "left").select("fp", F.coalesce("first", "lo").alias("first")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, distance: int = MAX_DISTANCE, crowded: int = CROWDED, similar: bool = False) -> DataFrame:
    """id, text_hash, fp (long), component_id and representative of every row. With similar, texts of SIMILAR 5-word shingles are linked too.

    The representative of a component has its smallest id (nulls last) and, of those, the smallest hash of the text; rows that repeat both are all marked.
    """
    scratch = Scratch(docs.sparkSession, "near")
    rank = lambda: F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("text_hash"))
    ids = scratch.keep(docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), fingerprint(F.col(text_col), size).alias("fp")))
    fps = scratch.keep(ids.groupBy("fp").agg(F.min(rank()).alias("lo")))
    edges = scratch.keep(links(fps, distance, crowded, scratch))
    if similar:
        texts = docs.select(F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
        prints = scratch.keep(ids.select(F.col("text_hash").alias("h"), "fp").distinct())
        edges = similar_links(texts, prints, edges, scratch)
    found = ids.join(_firsts(fps, components(edges, scratch), scratch), "fp")
    return found.select(F.col("id").alias(id_col), "text_hash", "fp", F.col("first.id").alias("component_id"), (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash"))).alias("representative"))


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")
