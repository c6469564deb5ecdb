"""Seed, chain, extend: against a full alignment table in plain Python, and reads whose place is known."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from germlight.operators import chain, kmer
from germlight.operators.chain import END_BONUS, EXTEND, MATCH, MISMATCH, OPEN

COMPLEMENT = str.maketrans("ACGT", "TGCA")


def reverse(s):
    return s.translate(COMPLEMENT)[::-1]


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def best_score(read, window):
    """Of all alignments of read anywhere in window, with clips: three full tables, cell by cell."""
    low, m, n = -(10**9), len(read), len(window)
    h, up, left = ([[low] * (n + 1) for _ in range(m + 1)] for _ in range(3))
    best = 0
    for i in range(m + 1):
        for j in range(n + 1):
            free = j == 0 or window[j - 1] != "-"
            options = [0 if i == 0 else -END_BONUS] if j == n or window[j] != "-" else []
            if i and (j == 0 or free):
                up[i][j] = max(h[i - 1][j] - OPEN, up[i - 1][j]) - EXTEND
                options.append(up[i][j])
            if j and i and free:
                left[i][j] = max(h[i][j - 1] - OPEN, left[i][j - 1]) - EXTEND
                options += [left[i][j], h[i - 1][j - 1] + (MATCH if read[i - 1] == window[j - 1] != "N" else -MISMATCH)]
            h[i][j] = max(options, default=low)
            best = max(best, h[i][j] - (END_BONUS if i < m else 0))
    return best


def rescored(read, window, start, cigar):
    """(score, edit distance) of a given alignment."""
    score = edits = i = 0
    j, steps = start, [(int(n), op) for n, op in re.findall(r"(\d+)([MIDS])", cigar)]
    for n, op in steps:
        if op == "S":
            score, i = score - END_BONUS, i + n
        elif op == "I":
            score, edits, i = score - OPEN - EXTEND * n, edits + n, i + n
        elif op == "D":
            score, edits, j = score - OPEN - EXTEND * n, edits + n, j + n
        else:
            for x, y in zip(read[i : i + n], window[j : j + n], strict=True):
                assert y != "-"
                same = x == y != "N"
                score, edits = score + (MATCH if same else -MISMATCH), edits + (not same)
            i, j = i + n, j + n
    assert i == len(read) and all(op != "S" for _, op in steps[1:-1])
    return score, edits


@given(st.lists(st.tuples(st.text("ACGTN", min_size=1, max_size=24), st.integers(0, 6), st.text("ACGT", min_size=1, max_size=30)), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_banded_alignment_is_that_of_the_full_table(cases):
    reads, windows = [r for r, _, _ in cases], ["-" * lead + w for _, lead, w in cases]
    wide = max(map(len, windows)) + 1
    for (score, start, cigar, edits), read, window in zip(chain.banded([r.encode() for r in reads], [w.encode() for w in windows], wide), reads, windows):
        if score > 0:
            assert rescored(read, window, start, cigar) == (score, edits)
        # A band of all j >= i leaves alignments below the diagonal out: it may only miss those.
        assert score <= best_score(read, window)
        shifted = "-" * len(read) + window
        (again, at, steps, _), = chain.banded([read.encode()], [shifted.encode()], len(shifted) + 1)
        assert max(again, 0) == best_score(read, shifted) and (again <= 0 or rescored(read, shifted, at, steps)[0] == again)


def test_chains_bridge_gaps():
    rng = random.Random(4)
    seeds = [{"position": q, "flipped": False, "n": 1, "places": [{"reference": "r", "position": q + 500 + (7 if q > 60 else 0), "flipped": False}]} for q in range(0, 120, 8)]
    seeds += [{"position": q, "flipped": True, "n": 2, "places": [{"reference": "x", "position": rng.randrange(10_000), "flipped": False}] * 2} for q in range(0, 120, 30)]
    seeds.append({"position": 3, "flipped": False, "n": 10**6, "places": [{"reference": "poly", "position": p, "flipped": False} for p in range(64)]})
    found = chain.candidates(150, seeds, 15)
    assert (found[0]["reference"], found[0]["low"], found[0]["high"], found[0]["anchors"], found[0]["unique"]) == ("r", 500, 507, 15, True)
    assert all(c["reference"] != "poly" for c in found)
    assert [c["unique"] for c in chain.candidates(150, seeds[-1:], 15)] == [False] * chain.CANDIDATES


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(8)
    refs = {"a": dna(rng, 20_000), "b": dna(rng, 9000), "short": dna(rng, 160)}
    refs["twin"] = refs["b"][2000:3000]
    refs["near"] = refs["a"][5000:5300] + "T" + refs["a"][5301:6000]
    refs["poly"] = "A" * 3000
    return refs, spark.createDataFrame(list(refs.items()), "reference string, sequence string")


def by_read(df):
    return {r["read_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def planted(spark, world):
    refs, _ = world
    rng, reads, truth = random.Random(9), {}, {}
    for n in range(120):
        name = rng.choice(["a", "b"])
        at = rng.randrange(4100, 4800) if name == "a" else rng.randrange(100, 1500)
        s = refs[name][at : at + 120]
        kind, x = n % 6, rng.randrange(45, 70)
        cigar, nm = "120M", 0
        if kind == 1:
            s, cigar, nm = s[:x] + s[x + 4 :], None, 4
        elif kind == 2:
            s, cigar, nm = s[:x] + dna(rng, 3) + s[x:], None, 3
        elif kind == 3:
            for y in (x, x + 9):
                s = s[:y] + "ACGT"[("ACGT".index(s[y]) + 1) % 4] + s[y + 1 :]
            nm = 2
        elif kind == 4:
            s, cigar = dna(rng, 40) + s, None
        turned = n % 2 == 1
        reads[f"r{n}"], truth[f"r{n}"] = reverse(s) if turned else s, (name, at, turned, cigar, nm, kind)
    reads |= {"twin": refs["twin"][300:420], "near": refs["near"][250:370], "over": dna(rng, 30) + refs["short"][:90], "past": refs["short"][-90:] + dna(rng, 30), "none": dna(rng, 120), "tiny": "ACGT", "empty": "", "null": None, "poly": "A" * 100, "lower": refs["a"][4200:4320].lower()}
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(reads.items())], "read_id string, ordinal long, sequence string")
    return df, reads, truth


def test_reads_find_their_place(spark, world, planted):
    refs, table = world
    df, reads, truth = planted
    got = by_read(chain.align(df, chain.build_index(table)))
    for name, (reference, at, turned, cigar, nm, kind) in truth.items():
        r = got[name]
        assert (r["reference_name"], r["reverse"]) == (reference, turned), name
        assert r["sequence"] == (reverse(reads[name]) if turned else reads[name])
        if kind != 4:
            assert r["reference_start"] == at and r["mismatches"] <= nm and r["mapq"] == 60, (name, r)
        assert cigar in (None, r["cigar"])
        score, edits = rescored(r["sequence"], refs[reference], r["reference_start"], r["cigar"])
        assert (score, edits) == (r["score"], r["mismatches"])
        near = refs[reference][max(0, at - 60) : at + 190]
        assert r["score"] == best_score(r["sequence"], near), name
    assert (got["twin"]["reference_name"], got["twin"]["mapq"]) == ("b", 0)
    assert got["near"]["reference_name"] == "near" and got["near"]["mismatches"] == 0 and got["near"]["mapq"] < 30
    assert (got["over"]["reference_start"], got["over"]["cigar"]) == (0, "30S90M") and got["past"]["cigar"] == "90M30S"
    assert got["lower"]["reference_start"] == 4200
    assert not {"none", "tiny", "empty", "null"} & set(got)


def test_index_is_written_and_read(spark, world, planted, tmp_path):
    _, table = world
    df, _, _ = planted
    index = chain.build_index(table, 13, 7)
    chain.write_index(index, str(tmp_path / "i"))
    back = chain.read_index(spark, str(tmp_path / "i"))
    assert (back.k, back.w) == (13, 7) and chain.read_index(spark, str(tmp_path / "none")) is None
    assert by_read(chain.align(df, back)) == by_read(chain.align(df, index))
    assert max(len(r["places"]) for r in back.seeds.collect()) <= chain.MAX_PLACES


def test_frequent_seeds_stay_bounded(spark):
    """A repeat of 20,000 places and 200 reads of it: no row has more than MAX_PLACES places, and each read has one of them, of quality 0."""
    rng = random.Random(1)
    unit = dna(rng, 200)
    index = chain.build_index(spark.createDataFrame([(f"r{i}", unit * 500) for i in range(2)], "reference string, sequence string"))
    assert index.seeds.agg({"n": "max"}).first()[0] >= 499 and index.seeds.selectExpr("max(size(places))").first()[0] == chain.MAX_PLACES
    reads = spark.createDataFrame([(f"q{i}", i, (unit * 2)[i : i + 100]) for i in range(200)], "read_id string, ordinal long, sequence string")
    got = chain.align(reads, index).collect()
    assert len(got) == 200 and all(r["mapq"] == 0 and r["mismatches"] == 0 and r["reference_name"] == "r0" for r in got)
    assert chain.align(reads.limit(0), index).collect() == []


@pytest.mark.parametrize("bases, broadcast", [(99_999, False), (100_000, True)])
def test_large_references_are_not_broadcast(spark, monkeypatch, bases, broadcast):
    """The planner's guess of a computed text or of exploded rows is far too low: only counted references may go through the driver, and the result is the same."""
    for module in (kmer, chain):
        monkeypatch.setattr(module, "SMALL_BASES", bases)
    rng = random.Random(8)
    refs = [(f"r{i}", "".join(rng.choice("ACGT") for _ in range(1000))) for i in range(100)]
    reads = [(f"q{i}", i, s[100:200]) for i, (_, s) in enumerate(refs)]
    table, own = spark.createDataFrame(refs, "reference string, sequence string"), spark.createDataFrame(reads, "read_id string, ordinal long, sequence string")
    votes = kmer.vote(own, table)
    for found in (chain.align(own, chain.build_index(table)), kmer.align(own, table), votes):
        assert ("BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()) == broadcast
        assert {r["read_id"]: r["reference" if found is votes else "reference_name"] for r in found.collect()} == {f"q{i}": f"r{i}" for i in range(100)}


def test_equal_reads_are_aligned_once(spark, monkeypatch):
    """Copies, whatever their case, take the alignment of one of them, each with its own name."""
    rng = random.Random(9)
    genome = "".join(rng.choice("ACGT") for _ in range(600))
    turned = genome[300:400].translate(str.maketrans("ACGT", "TGCA"))[::-1]
    kinds = [genome[50:150], genome[50:150].lower(), turned, "N" * 100, None]
    own = spark.createDataFrame([(f"q{i}", i, kinds[i % 5]) for i in range(500)], "read_id string, ordinal long, sequence string")
    seen, plain = spark.sparkContext.accumulator(0), chain._aligned
    monkeypatch.setattr(chain, "_aligned", lambda reads, *rest: plain(reads.where(F.udf(lambda _: seen.add(1) or True, "boolean")("read_id")), *rest))
    got = {r["read_id"]: (r["ordinal"], r["sequence"], r["reference_start"], r["reverse"], r["mismatches"]) for r in chain.align(own, chain.build_index(spark.createDataFrame([("r", genome)], "reference string, sequence string"))).collect()}
    assert got == {f"q{i}": (i, genome[50:150], 50, False, 0) if i % 5 < 2 else (i, genome[300:400], 300, True, 0) for i in range(500) if i % 5 < 3}
    assert 0 < seen.value < 200  # three sequences and one without a seed, as often as the plan uses them; the 500 reads would be more at its first use


def test_reads_of_few_sequences_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Each meets the alignment of its bases where it lies; the result is that of the shuffled join, which carries a digest and no bases."""
    rng = random.Random(10)
    genome = "".join(rng.choice("ACGT") for _ in range(900))
    kinds = [genome[i : i + 100] for i in range(0, 800, 40)] + [genome[5:17], "", None]
    spark.createDataFrame([(f"q{i}", i, kinds[i % len(kinds)]) for i in range(400)], "read_id string, ordinal long, sequence string").write.parquet(str(tmp_path / "reads"))
    own, index = spark.read.parquet(str(tmp_path / "reads")), chain.build_index(spark.createDataFrame([("r", genome)], "reference string, sequence string"))
    assert chain.of_few_sequences(own) and chain.of_few_sequences(own.limit(0))
    plans = {}
    for few in (False, True):
        found = chain.align(own, index, few=few)
        plans[few] = next(line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [_bases" in line)
        got = {r["read_id"]: (r["ordinal"], r["sequence"], r["reference_start"]) for r in found.collect()}
        assert got == {f"q{i}": (i, kinds[i % 23], 40 * (i % 23)) for i in range(400) if i % 23 < 20}
    assert "SortMergeJoin" in plans[False] and "BroadcastHashJoin" in plans[True]
    monkeypatch.setattr(chain, "SMALL_FOUND", 20 * 400)
    assert not chain.of_few_sequences(own)
