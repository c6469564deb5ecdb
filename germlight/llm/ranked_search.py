"""Ranked lexical search by Block-Max WAND over an index of document segments.

A segment holds the documents of one run of a task's input, until they have SEGMENT_TERMS terms. It is one row: its dictionary (terms in order, number of
postings of each), its documents (id, number of terms), and its posting blocks. A block holds up to BLOCK postings of one term, compressed as
differences of document numbers and term frequencies in as few bytes each as the block needs, and stores the documents it starts and ends at and the
maximum impact in it. A document's impact for a term is (10^9 tf) div (1000 tf + 12 m); a score sums weight times impact over the terms of a query.

A search takes the segments one after another and keeps the K best of each query as it goes. For a query it moves over the blocks of its terms by what they
store alone, with no block decompressed (shallow moves): between two borders of blocks no document scores more than the blocks around it allow together. Stretches
below the threshold, which is the K-th best score so far, are skipped; the others are scored in order of what they allow, their blocks
decompressed when first needed, and the threshold rises. Nothing is approximate.

Tasks read texts where they lie: no term or posting is shuffled. The numbers of documents and terms come from a scan before, a term's document
frequency from the dictionaries. Queries go to the tasks in lists of QUERY_BYTES at most, a pass over the index for each; only the best K of each
task meet in shuffles, in two steps, so that no query's rows from all tasks meet in one place.

Defined cases: a null, empty or termless text is no document; a null or termless item has no rows; items that repeat id and text are one query; a null doc_id
passes through and precedes others of equal score; documents that repeat an id each have their row; texts of any length are whole; an empty table on
either side gives an empty result; columns other than the named ones are ignored. Invalid UTF-8 is not expected.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from germlight.llm._shared import Scratch, table

BLOCK, K = 128, 20
#: Terms after which a segment is closed, bytes of queries in a pass, and documents that are scored before the threshold is looked at again, at first.
SEGMENT_TERMS, QUERY_BYTES, FIRST_DOCS = 1 << 22, 16 << 20, 128
NULL_ID = -(2**63)
#: Every byte of a separator becomes a blank, A-Z become a-z; in UTF-8 all bytes of other characters are 128 or more, and stay.
FOLD = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
SEGMENT = "docs long, terms binary, n_postings binary, ids binary, lengths binary, first binary, last binary, maximum binary, n binary, at binary, widths binary, blocks binary"


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def length_factor(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 75 + (25 * lengths.astype(np.int64) * n_docs) // n_terms


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 12 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _widths(most: np.ndarray) -> np.ndarray:
    """Bytes that numbers up to `most` take: 1, 2 or 4."""
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4)).astype(np.int64)


def _scatter(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    """Writes each value in its width, least byte first, at its place."""
    for k in range(4):
        wide = width > k
        out[at[wide] + k] = (values[wide] >> (8 * k)) & 255


class Builder:
    """Gathers documents until the segment is full."""

    def __init__(self, n_docs: int, n_terms: int):
        self.all_docs, self.all_terms = n_docs, n_terms
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.found: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        self.found.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        self.ids.append(NULL_ID if doc_id is None else doc_id)
        self.lengths.append(len(words))
        self.size += len(words)

    def segment(self) -> dict:
        names = sorted(self.numbers)
        rank = np.empty(len(names), np.int64)
        rank[[self.numbers[t] for t in names]] = np.arange(len(names))
        lengths = np.array(self.lengths, np.int64)
        # One number for each occurrence, (term, document); equal ones are a posting.
        pairs, tf = np.unique(rank[np.concatenate(self.found)] << 32 | np.repeat(np.arange(len(lengths)), lengths), return_counts=True)
        term, doc = pairs >> 32, pairs & 0xFFFFFFFF
        postings = np.bincount(term, minlength=len(names))
        within = np.arange(len(term)) - np.repeat(np.cumsum(postings) - postings, postings)
        start = np.flatnonzero(within % BLOCK == 0)  # where a block begins
        n = np.diff(np.append(start, len(term)))
        block = np.repeat(np.arange(len(start)), n)
        step = np.diff(doc, prepend=0)
        step[start] = 0
        maximum = np.maximum.reduceat(impact(tf, length_factor(lengths, self.all_docs, self.all_terms)[doc]), start)
        w_doc, w_tf = _widths(np.maximum.reduceat(step, start)), _widths(np.maximum.reduceat(tf, start))
        at = np.cumsum(n * (w_doc + w_tf)) - n * (w_doc + w_tf)
        out, p = np.zeros(int((n * (w_doc + w_tf)).sum()), np.uint8), np.arange(len(term)) - start[block]
        _scatter(out, at[block] + p * w_doc[block], step, w_doc[block])
        _scatter(out, at[block] + n[block] * w_doc[block] + p * w_tf[block], tf, w_tf[block])
        arrays = {"n_postings": (postings, "<u4"), "ids": (np.array(self.ids, np.int64), "<i8"), "lengths": (lengths, "<u4"), "first": (doc[start], "<u4"), "last": (doc[start + n - 1], "<u4"), "maximum": (maximum, "<u4"), "n": (n, "u1"), "at": (at, "<u8"), "widths": (w_doc << 4 | w_tf, "u1")}
        return {"docs": len(lengths), "terms": b" ".join(names), "blocks": out.tobytes()} | {name: x.astype(kind).tobytes() for name, (x, kind) in arrays.items()}


class Segment:
    """A stored segment, and what the queries of a task ask of it."""

    def __init__(self, row: dict, wanted: dict[bytes, int], n_docs: int, n_terms: int):
        load = lambda name, kind: np.frombuffer(row[name], kind).astype(np.int64)
        self.ids, self.blocks, self.widths, self.n = load("ids", "<i8"), row["blocks"], load("widths", "u1"), load("n", "u1")
        self.first, self.last, self.maximum, self.at = load("first", "<u4"), load("last", "<u4"), load("maximum", "<u4"), load("at", "<u8")
        self.m = length_factor(load("lengths", "<u4"), n_docs, n_terms)
        n_blocks = -(-load("n_postings", "<u4") // BLOCK)
        end = np.cumsum(n_blocks)
        #: term of the queries: its first block here, and the one after its last
        self.lists = {t: (int(end[i] - n_blocks[i]), int(end[i])) for i, t in enumerate(row["terms"].split()) if t in wanted}
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.scores = np.zeros(len(self.ids), np.int64)

    def postings(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block, decompressed once for all queries."""
        if (known := self.open.get(b)) is None:
            n, at, w_doc, w_tf = int(self.n[b]), int(self.at[b]), int(self.widths[b]) >> 4, int(self.widths[b]) & 15
            docs = np.cumsum(np.frombuffer(self.blocks, f"<u{w_doc}", n, at).astype(np.int64)) + self.first[b]
            known = self.open[b] = docs, impact(np.frombuffer(self.blocks, f"<u{w_tf}", n, at + n * w_doc), self.m[docs])
        return known

    def search(self, query: list[tuple[bytes, int]], best: Best) -> int:
        """Adds to best; query: (term, weight times its repeats). Returns how many blocks were decompressed or reused, of those the query's terms have here."""
        lists = [(*self.lists[t], w) for t, w in query if w and t in self.lists]
        if not lists:
            return 0
        own = np.concatenate([np.arange(a, b) for a, b, _ in lists])
        w = np.repeat([x for _, _, x in lists], [b - a for a, b, _ in lists])
        first, last, allowed = self.first[own], self.last[own], w * self.maximum[own]
        border, place = np.unique(np.concatenate([first, last + 1]), return_inverse=True)
        bound = np.cumsum(np.bincount(place, np.concatenate([allowed, -allowed]), len(border)).astype(np.int64))[:-1]
        docs = np.diff(border)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        self.scores[:] = 0
        done, taken, at, more = np.zeros(len(own), bool), 0, 0, FIRST_DOCS
        while at < len(order) and bound[order[at]] >= best.threshold:
            end = at + max(1, int(np.searchsorted(np.cumsum(docs[order[at:]]), more, "right")))
            stretches = order[at:end]
            stretches = np.sort(stretches[bound[stretches] >= best.threshold])
            low, high = border[stretches], border[stretches + 1]
            # Blocks that reach into a stretch: the last stretch that begins at or before a block's end must end after the block's start.
            k = np.searchsorted(low, last, "right") - 1
            for i in np.flatnonzero((k >= 0) & (high[np.maximum(k, 0)] > first) & ~done).tolist():
                where, impacts = self.postings(int(own[i]))
                self.scores[where] += w[i] * impacts
                done[i] = True
                taken += 1
            found = np.repeat(low - np.cumsum(high - low) + (high - low), high - low) + np.arange(int((high - low).sum()))
            best.add(self.scores[found], self.ids[found])
            at, more = end, more * 2
        return taken


class Best:
    """The K best of a query so far, equal scores by ascending id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.threshold = k, np.zeros(0, np.int64), np.zeros(0, np.int64), 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.threshold
        if not good.any():
            return
        scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.threshold = int(self.scores[-1])


def counted(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with a term, and all their terms."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        for batch in batches:
            for text in batch.column(0):
                n = len(terms(text.as_py()))
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
        yield pa.RecordBatch.from_pydict({"n_docs": [n_docs], "n_terms": [n_terms]})

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(each, "n_docs long, n_terms long").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    return found[0] or 0, found[1] or 0


def segments(docs: DataFrame, n_docs: int, n_terms: int, id_col: str = "doc_id", text_col: str = "text", segment_terms: int = SEGMENT_TERMS) -> DataFrame:
    """The index of docs, whose numbers of documents and terms are given: SEGMENT rows, one or more from each task."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(x.split()[0], pa.int64() if x.endswith("long") else pa.binary()) for x in SEGMENT.split(", ")])
        builder = Builder(n_docs, n_terms)
        for batch in batches:
            ids, texts = batch.columns
            for doc_id, text in zip(ids, texts):
                if words := terms(text.as_py()):
                    builder.add(doc_id.as_py(), words)
                if builder.size >= segment_terms:
                    yield pa.RecordBatch.from_pylist([builder.segment()], schema)
                    builder = Builder(n_docs, n_terms)
        if builder.size:
            yield pa.RecordBatch.from_pylist([builder.segment()], schema)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(each, SEGMENT)


def document_frequencies(index: DataFrame, wanted) -> DataFrame:
    """(term, df) of those broadcast terms that the index has; only dictionaries are read."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = wanted.value
        for batch in batches:
            for names, postings in zip(*batch.columns):
                hits = [(t, n) for t, n in zip(names.as_py().split(), np.frombuffer(postings.as_py(), "<u4").tolist()) if t in keys]
                yield pa.RecordBatch.from_pydict({"term": pa.array([t for t, _ in hits], pa.binary()), "df": pa.array([n for _, n in hits], pa.int64())})

    return index.select("terms", "n_postings").mapInArrow(each, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _best_of_tasks(index: DataFrame, queries, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(q, doc_id, score, task): the k best of each query in each task's segments; queries: broadcast lists of (term, weight)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        asked = queries.value
        wanted, best = dict.fromkeys(t for q in asked for t, _ in q), [Best(k) for _ in asked]
        for batch in batches:
            for row in range(batch.num_rows):
                segment = Segment({name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}, wanted, n_docs, n_terms)
                for query, found in zip(asked, best):
                    segment.search(query, found)
        n = [len(b.scores) for b in best]
        if sum(n):
            ids = np.concatenate([b.ids for b in best])
            out = {"q": np.repeat(np.arange(len(best)), n), "doc_id": pa.array(ids, pa.int64(), mask=ids == NULL_ID), "score": np.concatenate([b.scores for b in best]), "task": np.full(sum(n), TaskContext.get().partitionId())}
            yield pa.RecordBatch.from_pydict(out)

    return index.mapInArrow(each, "q long, doc_id long, score long, task long")


def _query_lists(items: DataFrame, item_id: str, item_text: str, query_bytes: int) -> Iterator[list[tuple]]:
    """Distinct (id, text) of items in lists of about query_bytes at most, or a single item, each list by itself in the driver."""
    own = items.select(F.col(item_id).alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text")).distinct()
    size = own.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    lists = -(-size // query_bytes)
    for i in range(lists):
        mine = own if lists == 1 else own.where(F.pmod(F.xxhash64("id", "text"), F.lit(lists)) == i)
        yield [(r["id"], r["text"]) for r in mine.collect()]


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", segment_terms: int = SEGMENT_TERMS, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score of every item."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    n_docs, n_terms = counted(docs, text_col)
    index = scratch.keep(segments(docs, n_docs, max(n_terms, 1), id_col, text_col, segment_terms))
    kind, out = items.schema[item_id].dataType.simpleString(), None
    for asked in _query_lists(items, item_id, item_text, query_bytes):
        found = search_index(spark, index, [terms(text) for _, text in asked], n_docs, max(n_terms, 1), k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(asked)], f"q long, `{item_id}` {kind}")
        part = found.join(F.broadcast(names), "q").select(item_id, "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], f"`{item_id}` {kind}, rank int, doc_id long, score long")


def search_index(spark: SparkSession, index: DataFrame, queries: list[list[bytes]], n_docs: int, n_terms: int, k: int = K) -> DataFrame:
    """q (place in queries), rank, doc_id and score over an index: queries that fit in the driver and in each task."""
    repeats = [Counter(q) for q in queries]
    wanted = spark.sparkContext.broadcast(frozenset(t for q in repeats for t in q))
    df = {bytes(r["term"]): r["df"] for r in document_frequencies(index, wanted).collect()}  # terms of these queries at most
    weighted = [[(t, n * weight(n_docs, df[t])) for t, n in sorted(q.items()) if t in df] for q in repeats]
    found = _best_of_tasks(index, spark.sparkContext.broadcast(weighted), n_docs, n_terms, k)
    order = (F.desc("score"), F.asc_nulls_first("doc_id"))
    few = found.withColumn("group", F.pmod(F.xxhash64("task"), F.lit(64))).withColumn("rank", F.row_number().over(Window.partitionBy("q", "group").orderBy(*order))).where(F.col("rank") <= k)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("rank") <= k)
    return best.select("q", "rank", "doc_id", "score")


def op11_block_max(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0) AS nd, CAST(sum(len(w)) AS BIGINT) AS nt FROM d),
p AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
r AS (SELECT item_id, rid, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // nt)))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN p USING (term), s GROUP BY ALL)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM r WHERE score > 0) WHERE rank <= 20
"""
