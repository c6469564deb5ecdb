"""Minimizers, lowest common ancestors and classification, against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from germlight.operators import lca, minimizers

COMPLEMENT = str.maketrans("ACGT", "TGCA")


def mixed(x):
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ x >> 33) * m % 2**64
    x ^= x >> 33
    return x - 2**64 if x >> 63 else x


def canonical(kmer):
    if set(kmer) - set("ACGT"):
        return None
    number = lambda s: sum("ACGT".index(c) << 2 * i for i, c in enumerate(reversed(s)))
    own, other = number(kmer), number(kmer.translate(COMPLEMENT)[::-1])
    a, b = mixed(own), mixed(other)
    return None if own == other else (min(a, b), b < a)


def places(sequence, k, w, key=canonical):
    marks = [key(sequence[i : i + k]) for i in range(len(sequence) - k + 1)]
    out = set()
    for s in range(max(len(marks) - w, 0) + 1):
        window = [(m[0], i, m[1]) for i, m in enumerate(marks[s : s + w], s) if m]
        if window:
            v, i, flipped = min(window)
            out.add((i, v, flipped))
    return out


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


@pytest.mark.parametrize("k, w", [(15, 10), (4, 3), (7, 1)])
def test_minimizers(spark, k, w):
    rng = random.Random(1)
    own = {"long": dna(rng, 3000), "gap": dna(rng, 300) + "N" * 40 + dna(rng, 280), "few": dna(rng, k + 1), "one": dna(rng, k), "none": dna(rng, k - 1), "same": "A" * 700, "odd": dna(rng, 30) + "é" + dna(rng, 60), "empty": "", "null": None}
    df = spark.createDataFrame(list(own.items()), "name string, sequence string")
    got: dict[str, set] = {}
    for r in minimizers.minimizers(df, "name", k=k, w=w).collect():
        got.setdefault(r["name"], set()).add((r["position"], r["v"], r["flipped"]))
    for name, sequence in own.items():
        assert got.get(name, set()) == (places(sequence, k, w) if sequence else set()), name


def test_minimizers_of_text_and_parts(spark, monkeypatch):
    for name, n in (("CHUNK", 64), ("PIECE", 16), ("RUN", 8)):
        monkeypatch.setattr(minimizers, name, n)
    text = "".join(random.Random(2).choice("ab é") for _ in range(500))
    df = spark.createDataFrame([("t", text)], "name string, sequence string")
    got = {(r["position"], r["v"]) for r in minimizers.minimizers(df, "name", k=5, w=4, key=minimizers.alphabetic).collect()}
    assert got == {(i, v) for i, v, _ in places(text, 5, 4, lambda x: (x.encode(), False)) for v in [v.decode()]}


TREE = {1: None, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3, 7: 5, 8: 8, 9: 8, 10: 99}


def way(node):
    out = []
    while node is not None:
        out.append(node)
        up = TREE.get(node)
        node = up if up != node and up in TREE else None
    return out[::-1]


def meet(nodes):
    ways = [way(n) for n in nodes]
    out = []
    for level in zip(*ways):
        if len(set(level)) > 1:
            break
        out.append(level[0])
    return out[-1] if out else None


@pytest.fixture(scope="module")
def paths(spark):
    return lca.root_paths(spark.createDataFrame([*TREE.items(), (4, 2)], "taxid long, parent long")).cache()


def test_root_paths(spark, paths):
    assert {r["taxid"]: r["path"] for r in paths.collect()} == {n: way(n) for n in TREE}
    chain = spark.createDataFrame([(i, i - 1) for i in range(1, 70)] + [(0, None)], "taxid long, parent long")
    assert lca.root_paths(chain).where("taxid = 69").first()["path"] == list(range(70))
    with pytest.raises(ValueError, match="cycle"):
        lca.root_paths(spark.createDataFrame([(1, 2), (2, 1)], "taxid long, parent long"))


def test_lowest_common_ancestors(spark, paths):
    rng = random.Random(3)
    groups = {i: rng.choices([n for n in TREE], k=rng.randint(1, 4)) for i in range(60)}
    df = spark.createDataFrame([(i, n) for i, ns in groups.items() for n in ns], "g long, taxid long").join(paths, "taxid")
    assert {r["g"]: (r["path"] or [None])[-1] for r in lca.lowest_common_ancestors(df, "g").collect()} == {i: meet(ns) for i, ns in groups.items()}


def classified(known, sequence, k, w, confidence):
    own = {v for _, v, _ in places(sequence or "", k, w)} if sequence and len(sequence) >= k else set()
    hits = Counter(known[v] for v in own if v in known)
    score = {n: sum(hits[a] for a in way(n)) for n in hits}
    if not hits:
        return None, len(own), 0, 0, 0
    best = max(score.values())
    call = meet([n for n, s in score.items() if s == best])
    while call is not None:
        support = sum(c for n, c in hits.items() if call in way(n))
        if support >= confidence * len(own):
            return call, len(own), hits.total(), best, support
        call = way(call)[-2] if len(way(call)) > 1 else None
    return None, len(own), hits.total(), 0, 0


@pytest.mark.parametrize("confidence", [0.0, 0.3, 0.6, 1.0])
def test_classification(spark, paths, confidence):
    k, w, rng = 9, 4, random.Random(5)
    shared, base = dna(rng, 150), dna(rng, 400)
    genomes = {n: dna(rng, 300) + (shared if n in (4, 5, 6) else "") + (base[100:250] if n in (4, 7) else "") for n in (4, 5, 6, 7, 10)} | {9: dna(rng, 200)}
    genomes[7] += genomes[5][:120]
    of: dict[int, set] = {}
    for n, s in genomes.items():
        for _, v, _ in places(s, k, w):
            of.setdefault(v, set()).add(n)
    known = {v: meet(ns) for v, ns in of.items() if meet(ns) is not None}
    reads = {"shared": shared, "foreign": dna(rng, 150), "short": "ACGT", "null": None, "deep": genomes[7][20:140], "both": genomes[7][-150:], "base": base[80:260]}
    reads |= {f"r{i}": genomes[rng.choice(list(genomes))][(at := rng.randrange(150)) : at + 60] + dna(rng, 30) for i in range(40)}
    halves = (genomes[4][:60] + genomes[6][:x] for x in range(40, 80))
    reads["tie"] = next(s for s in halves if (c := classified(known, s, k, w, 0.0))[0] == 1 and 0 < c[3] < c[2])
    reads["reverse"] = genomes[9][20:120].translate(COMPLEMENT)[::-1]
    refs = spark.createDataFrame(list(genomes.items()), "taxid long, sequence string")
    database = lca.database(refs, paths, k, w)
    assert {r["v"]: r["taxid"] for r in database.collect()} == known
    got = lca.classify(spark.createDataFrame(list(reads.items()), "read_id string, sequence string"), database, paths, k=k, w=w, confidence=confidence).collect()
    assert {r["read_id"]: (r["taxid"], r["n_minimizers"], r["n_hits"], r["score"], r["support"]) for r in got} == {i: classified(known, s, k, w, confidence) for i, s in reads.items()}
    if not confidence:
        assert {r["read_id"]: r["taxid"] for r in got}["tie"] == 1 and {r["read_id"]: r["taxid"] for r in got}["reverse"] == 9


def test_profile_and_assignments(spark, paths):
    calls = spark.createDataFrame([("a", 0, 4, 10, 5, 5, 5), ("b", 1, 7, 10, 5, 5, 2), ("c", 2, 2, 4, 1, 1, 1), ("d", 3, None, 4, 0, 0, 0)], "read_id string, ordinal long, taxid long, n_minimizers long, n_hits long, score long, support long")
    got = {r["taxid"]: (r["n_reads"], r["n_clade"]) for r in lca.profile(calls, paths).collect()}
    assert got == {1: (0, 3), 2: (1, 3), 4: (1, 1), 5: (0, 1), 7: (1, 1), None: (1, 1)}
    reads = calls.select("read_id", "ordinal", F.lit("ACGT").alias("sequence"))
    names = spark.createDataFrame([(2, "Genus", "genus"), (5, "Genus five", "species"), (4, "Genus four", "species")], "taxid long, name string, rank string")
    out = {r["read_id"]: (r["species"], r["genus"], r["confidence"], r["classified"]) for r in lca.assignments(reads, calls, names, paths).collect()}
    assert out == {"a": ("Genus four", "Genus", 0.5, True), "b": ("Genus five", "Genus", 0.2, True), "c": ("unclassified", "Genus", 0.25, False), "d": ("unclassified", "unclassified", 0.0, False)}


def test_minimizers_of_text_in_batches(spark, monkeypatch):
    """Text takes batches, in order of code points whatever their number, and gives what plain Python does, however rows are grouped; distinct ones whatever rows and parts a key has."""
    monkeypatch.setattr(minimizers, "AT_ONCE", 50)
    rng = random.Random(5)
    own = {"ascii": "".join(rng.choice("abc ") for _ in range(300)), "wide": "".join(chr(rng.choice([97, 0xE9, 0x4E2D, 0x1F600, 0xFFFD])) for _ in range(200)), "many": "".join(chr(rng.randrange(0x100, 0x900)) for _ in range(200)), "short": "abcdef", "none": "ab", "empty": "", "null": None}
    df = spark.createDataFrame(list(own.items()), "name string, sequence string").coalesce(1)
    for k, w in ((4, 3), (11, 5)):
        found = minimizers.minimizers(df, "name", k=k, w=w, key=minimizers.alphabetic)
        assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
        got = {(r["name"], r["position"], r["v"]) for r in found.collect()}
        assert got == {(name, i, v) for name, s in own.items() if s for i, v, _ in places(s, k, w, lambda x: (x, False))}
    twice = df.union(df.where("name = 'ascii'")).union(spark.createDataFrame([("ascii", "abcabc abcabc")], df.schema))
    for piece in (minimizers.PIECE, 40):
        monkeypatch.setattr(minimizers, "PIECE", piece)
        got = Counter((r["name"], r["v"]) for r in minimizers.distinct_minimizers(twice, "name", k=4, w=3, key=minimizers.alphabetic).collect())
        assert got == Counter({(name, v) for name, s in [*own.items(), ("ascii", "abcabc abcabc")] if s for _, v, _ in places(s, 4, 3, lambda x: (x, False))})


def test_spread_of_one_large_row_group(spark, tmp_path, monkeypatch):
    """A file of one row group is dealt out however large it is."""
    from germlight.plans import proxy

    spark.range(10_000).coalesce(1).write.parquet(str(tmp_path / "one"))
    monkeypatch.setattr(proxy, "SMALL", 1000)
    own = proxy.spread(spark.read.parquet(str(tmp_path / "one")))
    assert own.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    assert own.count() == 10_000 and own.groupBy(F.spark_partition_id()).count().count() == own.rdd.getNumPartitions()


def test_distinct_minimizers_leave_the_row_alone(spark):
    """Neither places nor flips, which nobody reads, go through the JVM with each distinct minimizer."""
    from germlight.operators import minimizers

    rows = spark.createDataFrame([(1, "ab cd ab cd ab cd"), (2, "")], "doc_id long, sequence string")
    plan = minimizers.distinct_minimizers(rows, "doc_id", k=3, w=2, key=minimizers.alphabetic)._jdf.queryExecution().executedPlan().toString()
    made = [line for line in plan.splitlines() if "MapInArrow" in line]
    assert len(made) == 2 and sum("position" in line or "flipped" in line for line in made) == 1


def test_first_of_each_is_exact_where_mixed_numbers_meet(monkeypatch):
    import numpy as np

    from germlight.operators import minimizers

    numbers = [np.array([0, 0, 0, 1, 1]), np.array([5, 7, 5, 5, 5], np.uint64)]
    assert minimizers._first_of_each(numbers).tolist() in ([0, 1, 3], [0, 1, 4], [1, 2, 3], [1, 2, 4])
    monkeypatch.setattr(minimizers, "mixed", lambda x: np.zeros(len(x), np.int64))
    kept = minimizers._first_of_each(numbers)
    assert sorted(zip(*(x[kept].tolist() for x in numbers))) == [(0, 5), (0, 7), (1, 5)]


def test_least_windows_equal_brute_force():
    """Windows of two-word keys, within sequences only; one shorter than a window has its least key."""
    import numpy as np

    from germlight.operators import minimizers

    random = np.random.default_rng(7)
    for w in (1, 2, 3, 5, 6, 8, 11):
        sizes = random.integers(0, 15, 30)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        words = [random.integers(0, 3, bounds[-1]).astype(np.uint64), random.integers(0, 3, bounds[-1]).astype(np.uint64)]
        keys = list(zip(*(x.tolist() for x in words)))
        expected = {min(range(i, min(i + w, first + n)), key=lambda j: (keys[j], j)) for first, n in zip(bounds[:-1].tolist(), sizes.tolist()) if n for i in range(first, first + max(n - w, 0) + 1)}
        assert minimizers._least(words, bounds, sizes, w).tolist() == sorted(expected)
