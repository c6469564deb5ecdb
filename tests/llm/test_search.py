"""Ranked search and document fingerprints, against definitions in plain Python."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from germlight.llm import fingerprints, ranked_search
from germlight.llm.fingerprints import Fingerprint, edit, paragraphs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, k=20):
    """{(item, rank): (doc, score)} by the definition."""
    words = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    words = [(i, c) for i, c in words if c]
    n_docs, n_terms, df = len(words), sum(c.total() for _, c in words), Counter(t for _, c in words for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = {}
    for item, text in items:
        own = TERM.findall((text or "").translate(LOWER))
        scores = []
        for i, c in words:
            m = 75 + (25 * c.total() * n_docs) // n_terms
            scores.append((-sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in own if t in c), i is not None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(s for s in scores if s[0] < 0)[:k], 1):
            out[item, rank] = (i, -score)
    return out


def searched(spark, docs, items, **options):
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    return {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in ranked_search.search(docs, items, **options).collect()}


def test_terms_are_those_of_the_pattern():
    for text in ("A-b_C9 déjà ÉTÉ x y İK", "", None, "\x7f\x80\x00a", "日本 語A1"):
        assert [t.decode() for t in ranked_search.terms(text)] == TERM.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("segment_terms, query_bytes", [(1 << 22, 1 << 20), (300, 200), (1, 1 << 20)])
def test_search_is_that_of_the_definition(spark, segment_terms, query_bytes):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)]
    draw = lambda n: " ".join(vocabulary[min(59, int(x))] for x in rng.exponential(8, n))
    docs = [(i, draw(int(rng.integers(1, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[0][1]) for i in range(60)] + [(500, None), (501, ""), (502, " -- "), (None, docs[3][1]), (7, docs[7][1]), (503, "w1 " * 3000)]
    items = [("a", draw(9)), ("b", "W0 w0 w1 unseen"), ("c", None), ("d", "..."), ("e", docs[0][1]), ("a2", "w59"), ("f", " ".join(vocabulary))]
    assert searched(spark, docs, items, segment_terms=segment_terms, query_bytes=query_bytes) == ranked(docs, items)


def test_search_of_odd_tables(spark):
    assert searched(spark, [], [("a", "x")]) == {}
    assert searched(spark, [(1, "x")], []) == {}
    assert searched(spark, [(1, None)], [("a", "x")]) == {}
    assert searched(spark, [(1, "x"), (2, "x y")], [("a", "y"), ("a", "y"), (None, "y")]) == {("a", 1): (2, ranked([(1, "x"), (2, "x y")], [("a", "y")])["a", 1][1]), (None, 1): (2, ranked([(1, "x"), (2, "x y")], [("a", "y")])["a", 1][1])}
    clashing = spark.createDataFrame([(1, "x y", 5, "q"), (2, "y", 6, "t")], "doc_id long, text string, score long, term string")
    items = spark.createDataFrame([("a", "y", 3)], "item_id string, text string, rank int")
    assert ranked_search.search(clashing, items).count() == 2


def test_blocks_below_the_threshold_stay_compressed():
    """One document of 40,000 holds the rare word; blocks of the frequent word elsewhere are never opened."""
    n = 40_000
    builder = ranked_search.Builder(n, 3 * n)
    for i in range(n):
        builder.add(i, [b"common", b"filler", b"rare" if i == 31_234 else b"other"])
    row = builder.segment()
    segment = ranked_search.Segment(row, {b"common": 0, b"rare": 0}, n, 3 * n)
    best = ranked_search.Best(1)
    opened = segment.search([(b"common", 1), (b"rare", 9000)], best)
    assert best.ids.tolist() == [31_234] and opened == 2
    assert sum(-(-x // ranked_search.BLOCK) for x in np.frombuffer(row["n_postings"], "<u4").tolist()) > 900
    assert len(row["blocks"]) < 2.1 * (3 * n)  # a byte for each difference and each frequency


def test_blocks_decompress_to_what_was_added():
    rng = np.random.default_rng(5)
    builder, want = ranked_search.Builder(1000, 10**6), {}
    for i in range(3000):
        words = [b"t%d" % x for x in rng.integers(0, 4, int(rng.integers(1, 6)))] + ([b"far"] * 70_000 if i in (5, 2900) else [])
        builder.add(i, words)
        for t, tf in Counter(words).items():
            want.setdefault(t, []).append((i, tf))
    row = builder.segment()
    segment = ranked_search.Segment(row, dict.fromkeys(want, 0), 1000, 10**6)
    for t, expected in want.items():
        a, b = segment.lists[t]
        got = [(int(d), int(i)) for k in range(a, b) for d, i in zip(*segment.postings(k))]
        assert got == [(d, int(ranked_search.impact(np.array([tf]), segment.m[[d]])[0])) for d, tf in expected]
        assert all(segment.maximum[k] == segment.postings(k)[1].max() for k in range(a, b))




@given(st.lists(st.text("ab \n", max_size=40), max_size=6), st.randoms())
@settings(max_examples=60, deadline=None)
def test_fingerprints_are_sums(parts, random):
    parts = [p for x in parts for p in x.split("\n")]
    whole, shuffled = Fingerprint.of(parts), parts[:]
    random.shuffle(shuffled)
    assert whole == Fingerprint.of(shuffled)
    assert whole == sum((Fingerprint.of([p]) for p in parts), Fingerprint())
    assert whole.edited(parts[:2], ["new paragraph, long enough", "x"]) == Fingerprint.of([*parts[2:], "new paragraph, long enough", "x"])
    assert Fingerprint.parse(str(whole)) == whole and whole.likeness(whole) == 1.0
    if parts:
        assert whole != Fingerprint.of([*parts, parts[0]])


def test_likeness_follows_the_shared_part():
    rng = np.random.default_rng(1)
    draw = lambda n: "\n".join("".join(rng.choice(list("abcdefgh "), 200)) for _ in range(n))
    a, b = draw(40), draw(40)
    for share in (0, 0.25, 0.5, 0.75, 1):
        cut = int(len(a) * share)
        assert abs(Fingerprint.of(paragraphs(a)).likeness(Fingerprint.of(paragraphs(a[:cut] + b[cut:]))) - share) < 0.2
    long = "x" * 3_000_000 + a
    assert Fingerprint.of([long]).likeness(Fingerprint.of([long[:-50]])) > 0.99
    assert Fingerprint.of([""]).likeness(Fingerprint.of(["", ""])) == 0.0


def check_edits(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.edits(df, **options).collect()
    order = [(r["k"], r["id"], r["text"]) for r in df.select(F.col("doc_id").isNotNull().alias("k"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.coalesce("text", F.lit("")).alias("text")).distinct().orderBy("k", "id", F.xxhash64("text")).collect()]
    follows = {x: order[(n + 1) % len(order)][2] for n, x in enumerate(order)}
    want = []
    for i, t in rows:
        text, after = t or "", follows[i is not None, i or 0, t or ""]
        own, new, nxt = (Fingerprint.of(paragraphs(x)) for x in (text, edit(text, after), after))
        want.append((i, len(text), hashlib.sha256(edit(text, after).encode()).hexdigest(), str(own), str(new), own.likeness(new), own.likeness(nxt)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_edits_are_those_of_the_definition(spark):
    rng = np.random.default_rng(2)
    draw = lambda n: "".join(rng.choice(list("ab é語\n"), n))
    rows = [(int(i), draw(int(rng.integers(0, 300)))) for i in rng.permutation(500)]
    check_edits(spark, rows + [(None, "null"), (None, None), (3, "same id"), (9, ""), (-5, "first"), (10**15, draw(100_000))])
    check_edits(spark, [(i, "copy\nof\na text that is long") for i in range(50)] + [(7, "hot row " * 4)] * 400)
    check_edits(spark, [(1, "alone\nhere")])
    check_edits(spark, [(1, "alone\nhere")] * 300)
    check_edits(spark, [(None, None)])
    assert fingerprints.edits(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    clashing = spark.createDataFrame([(1, "a b", True, 3), (2, "c", False, 4)], "doc_id long, text string, guard boolean, slot int")
    assert fingerprints.edits(clashing).count() == 2 and fingerprints.fingerprints(clashing).count() == 2


def test_query_over_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in fingerprints.op12_multiset_hash(spark, SF).collect()}
    assert len(got) == len(rows)
    rows.sort()
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        assert got[i]["edited_sha256"] == hashlib.sha256(edit(text or "", after or "").encode()).hexdigest()
        assert got[i]["fingerprint"] == str(Fingerprint.of(paragraphs(text or "")))
    assert np.mean([r["near_edited"] - r["near_next"] for r in got.values()]) > 0.3
