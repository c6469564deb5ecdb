"""Minimizers: of every w consecutive k-mers, the one of least key. Equal stretches of w + k - 1 characters, wherever they are, have equal minimizers, and a sequence
has about 2 / (w + 1) of them a character.

Sequences are cut into nested parts that share w + k - 2 characters, so that no row holds a chromosome's k-mers and no substring counts from far away. Bases, and text
in order of bytes, take numpy over Arrow batches, many sequences at once: some thirty times less work than by substrings. Other keys are built-in functions throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from germlight.functions.scalar import let
from germlight.operators.kmer import CHUNK, PIECE, RUN, cut

K, W = 15, 10
Key = Callable[[Column], Column]


#: A base's number; 4 stands for any other letter. Multipliers of the mixing of k-mers, which spreads poly-A and the like over all keys.
CODES = np.full(256, 4, np.uint64)
CODES[list(b"ACGT")] = range(4)
MIXERS = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
LAST = np.iinfo(np.int64).max
#: Characters that numpy takes at once; a part of more is taken alone.
AT_ONCE = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """One to one."""
    for m in MIXERS:
        x = (x ^ x >> np.uint64(33)) * m
    return (x ^ x >> np.uint64(33)).view(np.int64)


def canonical(kmer: Column) -> Column:
    """Stands for keys of DNA: the lesser one of a k-mer's number and that of its reverse complement, both mixed; flipped if it is the latter. K-mers with other letters, or that
    are their own reverse complement, have none. Case counts: sequences are to be in capitals."""
    raise NotImplementedError("minimizers() computes it over batches")


def _dna(data: np.ndarray, bounds: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in data, keys and flips of the minimizers of the sequences that data holds one after another; bounds: where each begins, and the end."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    codes = CODES[data]
    own, other = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for j in range(k):
        own = own << np.uint64(2) | codes[j : j + n] & np.uint64(3)
        other |= (np.uint64(3) - (codes[j : j + n] & np.uint64(3))) << np.uint64(2 * j)
    odd = np.concatenate([[0], np.cumsum(codes == 4)])
    sizes = np.maximum(np.diff(bounds) - k + 1, 0)  # k-mers of each
    a, b = mixed(own), mixed(other)
    keys = np.where((odd[k:] == odd[:n]) & (own != other), np.minimum(a, b), LAST)
    best = _least([keys], bounds, sizes, w)
    best = best[keys[best] != LAST]
    return best, keys[best], b[best] < a[best]


def _least(words: list[np.ndarray], bounds: np.ndarray, sizes: np.ndarray, w: int) -> np.ndarray:
    """Places of the least keys, the first of equals, of all windows of w k-mers; a key is a number in each of words, compared in order. sizes: k-mers of each sequence.
    The least of s places and that of as many further on give the least of twice as many, so a window takes log2(w) steps."""
    # Windows that begin at each place; a sequence of fewer than w k-mers has one of them all.
    counts = np.where(sizes >= w, sizes - w + 1, 0)
    starts = np.arange(counts.sum()) + np.repeat(bounds[:-1] - np.cumsum(counts) + counts, counts)
    at, least, span = np.arange(len(words[0])), words[0], 1
    while span < w and len(starts):
        step = min(span, w - span)
        x, y = least[step:], least[:-step]
        less = x < y
        if words[1:]:
            tied = np.flatnonzero(x == y)
            less[tied] = _before(words[1:], at[tied + step], at[tied])
        at, least, span = np.where(less, at[step:], at[:-step]), np.minimum(x, y), span + step
    best = at[starts]
    best = best[np.diff(best, prepend=-1) > 0]  # windows further on have theirs no earlier
    short = np.flatnonzero((sizes > 0) & (sizes < w))
    if not len(short):
        return best
    first, few = bounds[:-1][short], sizes[short]
    least_of = first
    for j in range(1, w):
        other = first + np.minimum(j, few - 1)
        least_of = np.where(_before(words, other, least_of), other, least_of)
    return np.sort(np.concatenate([best, least_of]))


def _before(words: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the keys at places a are less than those at b."""
    less = words[-1][a] < words[-1][b]
    for word in words[-2::-1]:
        x, y = word[a], word[b]
        less = (x < y) | (x == y) & less
    return less


def _packed(ranks: np.ndarray, m: int, bits: int) -> np.ndarray:
    """A number of the m ranks from each place on, the first of them in front."""
    if m == 1:
        return ranks
    half = _packed(ranks, m // 2, bits)
    both = half[: -(m // 2)] << np.uint64(m // 2 * bits) | half[m // 2 :]
    return both[:-1] << np.uint64(bits) | ranks[m - 1 :] if m % 2 else both


def _text(data: bytes, bounds: np.ndarray, k: int, w: int) -> tuple[np.ndarray, pa.Array, list[np.ndarray]]:
    """Places in data, in characters, k-mers, and numbers that tell them apart, of the minimizers in order of bytes, which is that of code points; bounds: the character at which each sequence begins, and the end."""
    points = np.frombuffer(data.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), pa.array([], pa.string()), []
    # As few bits a character as tell those of data apart, in their order.
    there = np.bincount(points) > 0
    ranks = (np.cumsum(there) - 1).astype(np.uint64)[points]
    bits = max(1, int(there.sum() - 1).bit_length())
    words = []
    for first in range(0, k, 64 // bits):
        words.append(_packed(ranks[first:], min(64 // bits, k - first), bits)[:n])
    best = _least(words, bounds, np.maximum(np.diff(bounds) - k + 1, 0), w)
    widths = np.where((points < 0x80) | (points >= 0xDC80) & (points < 0xDD00), 1, np.where(points < 0x800, 2, np.where(points < 0x10000, 3, 4)))
    offsets = np.concatenate([[0], np.cumsum(widths)])
    sizes = offsets[best + k] - offsets[best]
    ends = np.cumsum(sizes)
    taken = np.frombuffer(data, np.uint8)[np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[best] - ends + sizes, sizes)]
    return best, pa.StringArray.from_buffers(len(best), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(taken)), [word[best] for word in words]


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of some AT_ONCE characters together."""
    first, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > AT_ONCE:
            yield first, i
            first, held = i, 0
        held += n
    if held:
        yield first, len(sizes)


def _first_of_each(numbers: list[np.ndarray]) -> np.ndarray:
    """Places, ascending, of one of each set of equal numbers. Places are sorted by one mixed number; where different ones have the same, which is next to never, by all of them."""
    key = np.zeros(len(numbers[0]), np.uint64)
    for x in numbers:
        key = mixed(key ^ x.astype(np.uint64)).view(np.uint64)
    order = np.argsort(key)
    new = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in numbers])
    if np.any(new & (key[order][1:] == key[order][:-1])):
        order = np.lexsort(numbers[::-1])
        new = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in numbers])
    return np.sort(order[np.concatenate([[True], new])])


#: Of some rows: where each begins, and their minimizers' places, keys, flips, and numbers that tell the keys apart.
Found = tuple[np.ndarray, np.ndarray, pa.Array, pa.Array, list[np.ndarray]]


def _of_bases(pieces: DataFrame, keys: tuple[str, ...], k: int, w: int, once: bool) -> DataFrame:
    if not 1 <= k <= 31:
        raise ValueError("k-mers of bases have 1 to 31 of them")

    def found(rows: list[bytes]) -> Found:
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]).astype(np.int64)
        at, v, flipped = _dna(np.frombuffer(b"".join(rows), np.uint8), bounds, k, w)
        return bounds, at, pa.array(v), pa.array(flipped), [v]

    return _over_batches(pieces, keys, "long", lambda column: [s.encode("ascii", "replace") for s in column.to_pylist()], found, once)


def _of_text(pieces: DataFrame, keys: tuple[str, ...], k: int, w: int, once: bool) -> DataFrame:
    if k < 1:
        raise ValueError("k-mers have a character at least")

    def found(rows: list[bytes]) -> Found:
        bounds = np.concatenate([[0], np.cumsum([len(r) if r.isascii() else len(r.decode("utf-8", "surrogateescape")) for r in rows], dtype=np.int64)]).astype(np.int64)
        at, v, numbers = _text(b"".join(rows), bounds, k, w)
        return bounds, at, v, pa.array(np.zeros(len(at), bool)), numbers

    return _over_batches(pieces, keys, "string", lambda column: column.cast(pa.binary()).to_pylist(), found, once)


def _over_batches(pieces: DataFrame, keys: tuple[str, ...], kind: str, rows_of: Callable[[pa.Array], list[bytes]], found: Callable[[list[bytes]], Found], once: bool) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, begins = rows_of(batch.column("_s")), batch.column("_at").to_numpy(zero_copy_only=False)
            for first, last in _groups([len(r) for r in rows]):
                bounds, at, v, flipped, numbers = found(rows[first:last])
                row = np.searchsorted(bounds, at, "right") - 1
                columns = [pa.array((at - bounds[row] + begins[first + row]).astype(np.int64)), v, flipped]
                if once:  # places and flips stay here
                    keep = _first_of_each([row, *numbers]) if len(at) else np.zeros(0, np.int64)
                    row, columns = row[keep], [v.take(pa.array(keep))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(first + row)) for c in keys), *columns], names=[*keys, *(["v"] if once else ["position", "v", "flipped"])])

    own = pieces.select(*keys, "_at", "_s")
    kinds = ", ".join(f"`{c}` {own.schema[c].dataType.simpleString()}" for c in keys)
    return own.mapInArrow(each, f"{kinds}, v {kind}" if once else f"{kinds}, position long, v {kind}, flipped boolean")


def hashed(kmer: Column) -> Column:
    """A key of any text."""
    return F.struct(F.xxhash64(kmer).alias("v"), F.lit(False).alias("flipped"))


def alphabetic(kmer: Column) -> Column:
    """The k-mer itself as its key, in order of bytes. minimizers() computes it over batches, with the same result."""
    return F.struct(kmer.alias("v"), F.lit(False).alias("flipped"))


def _selected(run: Column, k: int, w: int, key: Key) -> Column:
    """array<struct<v, flipped, i>>: the minimizers of a short run in order of their place i, each once."""
    one = lambda kmer, i: let(key(kmer), lambda x: F.when(x["v"].isNotNull(), F.struct(x["v"].alias("v"), i.alias("i"), x["flipped"].alias("flipped"))))
    marks = F.transform(F.sequence(F.lit(1), F.greatest(F.length(run) - k + 1, F.lit(1))), lambda i: one(F.substring(run, i, F.lit(k)), i - 1))
    least = lambda m: F.transform(F.sequence(F.lit(0), F.greatest(F.size(m) - w, F.lit(0))), lambda s: F.array_min(F.slice(m, s + 1, w)))
    new = lambda best: F.filter(best, lambda x, i: x.isNotNull() & (i.eqNullSafe(0) | ~F.get(best, i - 1)["i"].eqNullSafe(x["i"])))
    return let(marks, lambda m: let(least(m), new))


def minimizers(df: DataFrame, *keys: str, k: int = K, w: int = W, key: Key = canonical, sequence: str = "sequence") -> DataFrame:
    """keys, position (0-based), v and flipped. A sequence with fewer than w k-mers has the least of them; without a k-mer it has none. Where parts meet a minimizer may come twice."""
    return _minimizers(df, keys, k, w, key, sequence)


def distinct_minimizers(df: DataFrame, *keys: str, k: int = K, w: int = W, key: Key = canonical, sequence: str = "sequence") -> DataFrame:
    """keys and v, each pair once. A key of one row that is one part, as most are, is done inside that row, so that only those of several shuffle their minimizers."""
    if key not in (canonical, alphabetic):
        return minimizers(df, *keys, k=k, w=w, key=key, sequence=sequence).select(*keys, "v").distinct()
    several = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.max(F.length(sequence)).alias("_most")).where((F.col("_n") > 1) | (F.col("_most") > PIECE)).select(*keys)
    one = _minimizers(df.join(several, [*keys], "left_anti"), keys, k, w, key, sequence, once=True)
    return one.unionByName(_minimizers(df.join(several, [*keys], "left_semi"), keys, k, w, key, sequence).select(*keys, "v").distinct())


def _minimizers(df: DataFrame, keys: tuple[str, ...], k: int, w: int, key: Key, sequence: str, once: bool = False) -> DataFrame:
    span = k + w - 1
    chunks = df.where(F.length(sequence) >= k).select(*keys, F.posexplode(cut(F.col(sequence), CHUNK, span)).alias("_c", "_s"))
    pieces = chunks.select(*keys, "_c", F.posexplode(cut(F.col("_s"), PIECE, span)).alias("_p", "_s"))
    pieces = pieces.select(*keys, (F.col("_c").cast("long") * CHUNK + F.col("_p") * PIECE).alias("_at"), "_s")
    if key is canonical:
        return _of_bases(pieces, keys, k, w, once)
    if key is alphabetic:
        return _of_text(pieces, keys, k, w, once)
    runs = F.transform(cut(F.col("_s"), RUN, span), lambda run, r: F.transform(_selected(run, k, w, key), lambda x: F.struct((x["i"] + r * RUN).alias("i"), x["v"].alias("v"), x["flipped"].alias("flipped"))))
    found = pieces.select(*keys, "_at", F.explode(F.flatten(runs)).alias("_x"))
    return found.select(*keys, (F.col("_at") + F.col("_x.i")).alias("position"), F.col("_x.v").alias("v"), F.col("_x.flipped").alias("flipped"))
