"""Hamming clusters in rounds against the greedy fold."""

import random

import pytest

from germlight.operators import quantify, umi


def greedy(codes, threshold):
    kept = []
    for c in codes:
        far = lambda k: sum(x != y for x, y in zip(k.ljust(max(len(k), len(c)), "N"), c.ljust(max(len(k), len(c)), "N"))) > threshold
        if all(far(k) for k in kept):
            kept.append(c)
    return kept


def groups(rng):
    draw = lambda n, a, length: ["".join(rng.choice(a) for _ in range(length)) for _ in range(n)]
    chain = ["A" * i + "C" * (8 - i) for i in range(9)]  # each one is next to the one before
    return {"random": draw(300, "ACGT", 8), "dense": draw(400, "AC", 6), "mixed": [c[: rng.randint(1, 8)] for c in draw(300, "ACN", 8)], "few": draw(3, "ACGT", 8), "chain": chain, "back": chain[::-1], "same": ["ACGTACGT"] * 50}


@pytest.mark.parametrize("threshold, fold, masks", [(1, 2, 100), (1, 10**6, 100), (2, 5, 100), (2, 3, 1), (1, 4, 1), (0, 2, 100)])
def test_rounds_equal_the_fold(spark, monkeypatch, threshold, fold, masks):
    monkeypatch.setattr(umi, "MASKS", masks)
    own = groups(random.Random(threshold * 7 + fold))
    rows = [(name, "c", code, i) for name, codes in own.items() for i, code in enumerate(codes)]
    df = spark.createDataFrame(rows, "species string, barcode string, umi string, ordinal long").repartition(5)
    got = {r["species"]: r["umis"] for r in umi.hamming_clusters(df, threshold=threshold, fold=fold).collect()}
    assert got == {name: greedy(codes, threshold) for name, codes in own.items()}


def test_large_group(spark):
    """One cell and species with 100,000 reads of 12 bases: all codes in one row would be folded for hours."""
    rng = random.Random(1)
    rows = [("s", "c", "".join(rng.choice("ACGT") for _ in range(12)), i, True) for i in range(100_000)]
    df = spark.createDataFrame(rows, "species string, barcode string, umi string, ordinal long, classified boolean").repartition(4)
    n = quantify.quantified(df, dedup="hamming").first()["n"]
    kept = {}
    for *_, code, _, _ in rows:  # the greedy clusters by looking up masked codes
        keys = [code[:i] + "*" + code[i + 1 :] for i in range(12)]
        if not any(k in kept for k in keys):
            kept.update(dict.fromkeys(keys, code))
    assert n == len(set(kept.values()))
