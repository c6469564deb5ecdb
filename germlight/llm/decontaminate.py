"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is WINDOW consecutive words of a benchmark item (a shorter item is one window of its own length). Each window, on either side, is
represented by the least hash of the GRAM-word grams inside it: equal windows have equal representatives, so every shared span of WINDOW words or
more is found. Document fingerprints (the distinct positions that represent some window, about two in seven) join the benchmark's; the hits are
extended to the windows around them, and those are compared word by word with the benchmark's windows.

Of a text only positions and hashes leave its row, so work and memory follow its length; the texts with hits, and no others, are split once more to compare
windows. The benchmark's side and the list of hits are broadcast up to BROADCAST_ROWS rows, counted first. Beyond that the planner joins by shuffle: of
fingerprints some 20 bytes each, and whole texts once, if the list of hits is longer.

Defined cases: a null or empty text has no words, no hits and an empty list of items; a null or wordless item occurs nowhere; a null item_id is
no part of a list of items; repeated items count once in the list, repeated documents each get their row; an empty benchmark contaminates nothing;
columns other than the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from germlight.llm._shared import Scratch, ascii_lower, bounded_broadcast, let, table

#: What separates words, after lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, GRAM = 10, 5
BROADCAST_ROWS = 500_000
#: More than any window has words.
LENGTHS = 1 << 12
#: Distinct sets of windows up to which their lists of items are broadcast.
BROADCAST_SETS = 20_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _grams(w: Column, gram: int) -> Column:
    """Hash of the gram at each position."""
    return F.when(F.size(w) < gram, F.array().cast("array<long>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - gram), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(gram)))))


def _least(h: Column, at: Column, n: int) -> Column:
    return F.get(h, at) if n == 1 else F.least(*(F.get(h, at + j) for j in range(n)))


def _selected(w: Column, length: int) -> Column:
    """array<struct<p, h>>: positions whose gram represents some window of that length, with the hash."""
    gram = min(GRAM, length)
    span = length - gram + 1  # grams in a window
    if span == 1:
        return let(_grams(w, gram), lambda h: F.transform(h, lambda x, i: F.struct(i.alias("p"), x.alias("h"))))
    minima = lambda h: F.when(F.size(h) < span, F.array().cast("array<long>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(h) - span), lambda i: _least(h, i, span)))
    # Gram p represents a window if it equals the least hash of the windows that start at p - span + 1 ... p; those outside the text are null.
    chosen = lambda h, m: F.filter(F.transform(h, lambda x, p: F.struct(p.alias("p"), x.alias("h"))), lambda s: F.greatest(F.lit(-(2**63)), *(F.get(m, s["p"] - j) for j in range(span))) == s["h"])
    return let(_grams(w, gram), lambda h: let(minima(h), lambda m: chosen(h, m)))


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item_id, len, h, window): the windows of every item, with the hash that represents each."""
    w = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    w = w.select("item_id", "w", F.least(F.size("w"), F.lit(window)).alias("len"))
    per = w.select("item_id", "len", "w", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("len"))).alias("s")).select("item_id", "len", F.slice("w", F.col("s") + 1, F.col("len")).alias("x"))
    # The representative of one window: the least gram hash within it, for grams of GRAM words, or of the whole of a shorter window.
    h = F.expr("CASE " + " ".join(f"WHEN len = {n} THEN least({', '.join(_gram_sql(i, min(GRAM, n)) for i in range(n - min(GRAM, n) + 1))}, 9223372036854775807L)" for n in range(1, window + 1)) + " END")
    return per.select("item_id", "len", h.alias("h"), F.array_join("x", " ").alias("window"))


def _gram_sql(at: int, gram: int) -> str:
    return f"xxhash64({', '.join(f'get(x, {at + j})' for j in range(gram))})"


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """id, text_hash, n_words, n_hit, n_items, items (sorted strings) and contaminated of every row of docs."""
    scratch = Scratch(docs.sparkSession, "windows")
    bench = scratch.keep(benchmark_windows(items, item_id, item_text, window))
    lengths = sorted(r["len"] for r in bench.select("len").distinct().collect())  # `window` values at most
    of_items = scratch.keep(bench.groupBy("len", "h", "window").agg(F.count("*").alias("_n")).drop("_n"))
    prints = bounded_broadcast(scratch.keep(of_items.select("len", "h").distinct()), BROADCAST_ROWS)

    # Positions, hashes and lengths alone leave a text's row. One row more for each document, of a hash that joins nothing, has its number of words: p = -1 - n.
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), words(F.col(text_col)).alias("w"))
    entry = lambda p, h, n: F.struct(p.cast("int").alias("p"), h.cast("long").alias("h"), F.lit(n).cast("int").alias("len"))
    prints_of = lambda n: F.transform(_selected(F.col("w"), n), lambda s: entry(s["p"], s["h"], n))
    found = F.concat(F.array(entry(-1 - F.size("w"), F.xxhash64("id", "th"), 0)), *map(prints_of, lengths))
    rows = own.select("id", "th", F.explode(found).alias("f")).select("id", "th", "f.p", "f.h", "f.len")
    rows = scratch.keep(rows.join(prints.select("len", "h", F.lit(True).alias("hit")), ["len", "h"], "left").where(F.col("hit") | (F.col("p") < 0)).select("id", "th", "p", "h", "len"))
    base, hits = rows.where("p < 0").select("id", "th", (-1 - F.col("p")).alias("n_words")), rows.where("p >= 0")

    # The texts with hits once more, with their hits: at most as many as a text has words. Only there the windows that hold a hit are cut out and compared.
    hits = scratch.keep(hits.groupBy("id", "th").agg(F.collect_set(F.struct("p", "h", "len")).alias("hits")).withColumnsRenamed({"id": "_id", "th": "_th"}))
    again = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text")).join(bounded_broadcast(hits, BROADCAST_ROWS), F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
    starts = lambda x, w: F.sequence(F.greatest(F.lit(0), x["p"] + F.least(F.lit(GRAM), x["len"]) - x["len"]), F.least(x["p"], F.size(w) - x["len"]))
    # (start, length) as one number, since the distinct ones of structs would be found by comparing all pairs.
    coded = lambda x, w: F.transform(starts(x, w), lambda s: s.cast("long") * LENGTHS + x["len"])
    cut = lambda c, w: let(F.struct(F.floor(c / LENGTHS).cast("int").alias("s"), (c % LENGTHS).cast("int").alias("len")), lambda x: F.struct(x["s"].alias("s"), x["len"].alias("len"), F.array_join(F.slice(w, x["s"] + 1, x["len"]), " ").alias("window")))
    around = let(words(F.col("text")), lambda w: F.transform(F.array_distinct(F.flatten(F.transform("hits", lambda x: coded(x, w)))), lambda c: cut(c, w)))
    spans = again.select("id", "th", F.explode(around).alias("a")).select("id", "th", "a.s", "a.len", "a.window").join(bounded_broadcast(of_items, BROADCAST_ROWS), ["len", "window"])

    at = F.collect_set(F.struct("s", "len"))
    per_doc = spans.groupBy("id", "th").agg(at.alias("at"), F.array_sort(F.collect_set(F.struct("len", "h", "window"))).alias("windows"))
    n_hit = F.size(F.array_distinct(F.flatten(F.transform("at", lambda x: F.sequence(x["s"], x["s"] + x["len"] - 1)))))
    per_doc = scratch.keep(per_doc.select(F.col("id").alias("_id"), F.col("th").alias("_th"), n_hit.cast("long").alias("n_hit"), "windows", F.xxhash64("windows").alias("set")))

    # Documents with the same windows have the same items: those are listed once for each set of windows.
    sets = per_doc.groupBy("set").agg(F.first("windows").alias("windows"))
    of_window = bench.where(F.col("item_id").isNotNull()).select("len", "h", "window", F.col("item_id").cast("string").alias("item")).distinct()
    pairs = sets.select("set", F.explode("windows").alias("x")).select("set", "x.len", "x.h", "x.window").join(of_window, ["len", "h", "window"]).select("set", "item").distinct()
    lists = scratch.keep(pairs.groupBy("set").agg(F.array_sort(F.collect_list("item")).alias("items")))
    hit = bounded_broadcast(per_doc.select("_id", "_th", "n_hit", "set"), BROADCAST_ROWS)
    full = base.join(hit, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    # Without a hit, a set of its own: null would be one key of most rows.
    full = full.withColumn("set", F.coalesce("set", F.xxhash64("id", "th"))).join(bounded_broadcast(lists, BROADCAST_SETS), "set", "left")
    n_hit, items_ = F.coalesce("n_hit", F.lit(0).cast("long")), F.when(F.col("n_hit") > 0, F.col("items"))
    full = full.select("id", "th", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.coalesce(items_, F.array().cast("array<string>")).alias("items"))
    return full.select(F.col("id").alias(id_col), F.col("th").alias("text_hash"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    df = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return df.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS x FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM b)),
dw AS (SELECT rid, s, n, array_to_string(w[s:s + n - 1], ' ') AS x FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM b))),
h AS (SELECT rid, s, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.x = bw.x),
p AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS q FROM h) GROUP BY rid),
i AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN i USING (rid)
"""
