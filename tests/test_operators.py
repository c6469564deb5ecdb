"""Hand-checkable inputs for each operator."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from germlight.functions import scalar
from germlight.operators import contamination, genomes, host, kmer, matrix, qc, quantify, reads, taxonomy, umi
from germlight.operators.dedup import last_wins
from germlight.sources.kraken import parse_kraken
from germlight.sources.sam import parse_sam


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def long_form(spark, dense, species=None, cells=None):
    species, cells = species or [f"s{i}" for i in range(len(dense))], cells or [f"c{j}" for j in range(len(dense[0]))]
    data = [(species[i], cells[j], int(n)) for i, row in enumerate(dense) for j, n in enumerate(row) if n]
    return spark.createDataFrame(data, "species string, barcode string, n long")


F6 = [("read1", 40, False, "AAAA-1", "TTTT"), ("read2", 1, False, "AAAA-1", "CCCC"), ("read3", 0, True, "BBBB-1", "AAAA"), ("read4", 30, False, None, ""), ("read5", 60, True, "", "A")]


@pytest.fixture(scope="module")
def few(spark):
    d = spark.createDataFrame(F6, "read_id string, mapq int, is_unmapped boolean, barcode string, umi string")
    return d.withColumns({"is_secondary": F.lit(False), "is_supplementary": F.lit(False), "ordinal": F.monotonically_increasing_id()})


def test_primary_filter(few):
    assert [r[0] for r in rows(host.host_primary(few).select("read_id"))] == ["read2", "read3", "read5"]
    assert host.host_stats(few, None).first().asDict() == {"primary_filtered": 2, "secondary_filtered": 0, "passed": 3}


def test_candidates_and_counters(spark, few):
    extra = few.limit(1).withColumns({"is_secondary": F.lit(True)})
    both = few.unionByName(extra)
    assert reads.candidate_reads(both).count() == 3
    assert reads.candidate_reads(both, include_unmapped=False).count() == 1
    assert reads.candidate_reads(both, include_low_mapq=False).count() == 2
    got = reads.parse_stats(both).first().asDict()
    assert got == {"total_reads": 6, "mapped_reads": 3, "unmapped_reads": 2, "low_mapq_reads": 1, "reads_with_barcode": 3, "reads_with_umi": 4, "candidate_reads": 3}
    from pyspark.sql import Observation

    seen = Observation()
    assert reads.observed_parse_stats(both, seen).count() == 6
    assert seen.get["candidate_reads"] == 3


def test_barcodes(spark, few):
    assert rows(reads.unique_barcodes(few)) == [("AAAA-1",), ("BBBB-1",)]
    wanted = spark.createDataFrame([("AAAA",), ("BBBB-2",), ("",), (None,)], "barcode string")
    assert reads.reads_by_barcode(few, wanted).count() == 3
    tags = spark.createDataFrame([("AAAA-1",), ("-x",), ("",), (None,), ("A-B-C",)], "t string")
    assert [r[0] for r in tags.select(scalar.barcode_of(F.col("t"))).collect()] == ["AAAA", "", "", None, "A"]


SAM = ["@HD\tVN:1.6", "short\t0\tref"] + [
    "\t".join([q, str(flag), ref, "11", str(mapq), "100M", "*", "0", "0", "A" * 100, "I" * 100, *([f"NM:i:{nm}"] if nm is not None else [])])
    for q, flag, ref, mapq, nm in [("r1", 0, "E.coli", 60, 4), ("r2", 0, "E.coli", 60, 5), ("r3", 0, "E.coli", 60, 6), ("r4", 0, "E.coli", 60, None), ("r5", 4, "*", 0, None), ("r6", 0, "x", 0, 0), ("r7", 0, "NC_000913.3 Escherichia coli", 30, 0), ("r8", 0, "a", 60, 0), ("r8", 0, "b", 60, 50)]
]


def test_sam_lines(spark):
    lines = spark.createDataFrame(list(enumerate(SAM)), "ordinal long, value string")
    parsed = parse_sam(lines)
    hits = {r["read_id"]: r for r in last_wins(host.host_hits(parsed), "read_id").collect()}
    assert {k: (r["identity"], r["is_host"]) for k, r in hits.items()} == {"r1": (96.0, True), "r2": (95.0, True), "r3": (94.0, False), "r4": (100.0, True), "r6": (100.0, True), "r7": (100.0, True), "r8": (50.0, False)}
    found = {r["read_id"]: r for r in last_wins(taxonomy.alignment_assignments(parsed), "read_id").collect()}
    assert set(found) == {"r1", "r2", "r3", "r4", "r7", "r8"}
    assert (found["r1"]["species"], found["r1"]["confidence"], found["r1"]["alignment_length"], found["r1"]["taxid"]) == ("E.coli", 1.0, 100, "unknown")
    assert (found["r7"]["species"], found["r7"]["confidence"], found["r8"]["species"]) == ("NC_000913.3 Escherichia", 0.5, "b")


def test_without_host(spark):
    own = spark.createDataFrame([("r1", 1), ("r1", 2), ("r2", 3), ("r3", 4)], "read_id string, x int")
    hits = spark.createDataFrame([("r1", 1, True), ("r2", 1, True), ("r2", 2, False)], "read_id string, ordinal long, is_host boolean")
    assert rows(host.without_host(own, hits)) == [("r2", 3), ("r3", 4)]
    assert rows(host.without_host(own, hits, "any_hit")) == [("r3", 4)]
    with pytest.raises(ValueError):
        host.without_host(own, hits, "other")


def test_kraken_lines(spark):
    data = ["C\tr1\t562\t100\troot;Bacteria;Escherichia;E.coli", "C\tr2\t1\t100\troot", "U\tr3\t0\t100\tunclassified", "C\tr4\t1\t5", "C\tr5\t562\t90\t562:13 561:4 A:31"]
    got = {r["read_id"]: r for r in parse_kraken(spark.createDataFrame([(x,) for x in data], "value string")).collect()}
    assert {k: (r["classified"], r["species"], r["genus"], r["confidence"]) for k, r in got.items()} == {
        "r1": (True, "E.coli", "Escherichia", 1.0), "r2": (True, "root", "unclassified", 1.0), "r3": (False, "unclassified", "unclassified", 0.0), "r5": (True, "562:13 561:4 A:31", "unclassified", 1.0),
    }
    named = parse_kraken(spark.createDataFrame([("C\tr1\tEscherichia coli K-12 (taxid 83333)\t100\t83333:5",)], "value string"), "names").first()
    assert (named["species"], named["genus"], named["taxid"]) == ("Escherichia coli", "Escherichia", "83333")


F7 = [("r1", "cell1", "UMI1", "E.coli"), ("r2", "cell1", "UMI1", "E.coli"), ("r3", "cell1", "UMI2", "E.coli"), ("r4", "cell2", "UMI3", "S.aureus"), ("r5", "cell2", "UMI4", "S.aureus")]


def test_quantification(spark):
    own = spark.createDataFrame([(i, *r, True) for i, r in enumerate(F7)], "ordinal long, read_id string, barcode string, umi string, species string, classified boolean")
    assert rows(quantify.quantified(own)) == [("E.coli", "cell1", 2), ("S.aureus", "cell2", 2)]
    assert rows(quantify.quantified(own, "reads")) == [("E.coli", "cell1", 3), ("S.aureus", "cell2", 2)]
    assert rows(quantify.quantified(own, dedup="hamming")) == [("E.coli", "cell1", 1), ("S.aureus", "cell2", 1)]
    s = quantify.quantification_stats(own).first()
    assert (s["total_umis"], s["deduplicated_umis"], s["pairs"]) == (5, 4, 2)
    bad = own.unionByName(spark.createDataFrame([(9, "a", None, "U", "x", True), (10, "b", "", "U", "x", True), (11, "c", "cell1", "", "x", True), (12, "d", None, None, "x", False), (13, "e", "cell1", "U", "x", None)], own.schema))
    assert rows(quantify.quantified(bad)) == rows(quantify.quantified(own))
    s = quantify.quantification_stats(bad).first()
    assert (s["total_reads"], s["valid_reads"], s["without_barcode"], s["without_umi"]) == (10, 5, 2, 1)
    with pytest.raises(ValueError):
        quantify.quantified(own, "other")


def plain_hamming(a, b):
    n = max(len(a), len(b))
    return sum(x != y for x, y in zip(a.ljust(n, "N"), b.ljust(n, "N")))


def test_hamming(spark):
    pairs = [("AAA", "AAAN"), ("AAA", "AAAA"), ("", "AA"), ("", ""), ("ACGT", "TGCA")]
    got = spark.createDataFrame(pairs, "a string, b string").select(scalar.hamming(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [plain_hamming(a, b) for a, b in pairs] == [0, 1, 2, 0, 4]
    lists = spark.createDataFrame([(["AAAA", "AAAT", "AATT", "CCCC", "AAAA"],), ([],)], "u array<string>")
    assert [r[0] for r in lists.select(umi.deduplicated(F.col("u"), "hamming")).collect()] == [["AAAA", "AATT", "CCCC"], []]
    assert lists.select(umi.deduplicated(F.col("u"))).first()[0] == ["AAAA", "AAAT", "AATT", "CCCC"]
    with pytest.raises(ValueError):
        umi.deduplicated(F.col("u"), "other")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ACGT", min_size=3, max_size=5), max_size=25))
def test_hamming_fold_equals_loop(spark, codes):
    kept = []
    for u in codes:
        if all(plain_hamming(u, k) > 1 for k in kept):
            kept.append(u)
    data = [(i, "s", "c", u) for i, u in enumerate(codes)]
    got = umi.hamming_clusters(spark.createDataFrame(data, "ordinal long, species string, barcode string, umi string")).collect()
    assert (got[0]["umis"] if got else []) == kept


F8 = [[10] + [0] * 9, [0, 8] + [0] * 8, [1] * 10, [0] * 8 + [5, 0]]


def test_contamination(spark):
    counts = long_form(spark, F8)
    scores = {r["species"]: r for r in contamination.specificity_scores(counts).collect()}
    assert scores["s0"]["cv"] == pytest.approx(3.0) and scores["s0"]["gini"] == pytest.approx(0.9) and scores["s3"]["specificity"] == pytest.approx(5.7)
    assert scores["s2"]["specificity"] == pytest.approx(0.0)
    masks = contamination.species_masks(counts, "ambient", 0.5, min_cells=2, specificity_threshold=1.0)
    assert contamination.contamination_stats(masks).first().asDict() == {"input_species": 4, "filtered_ambient": 1, "filtered_low_prevalence": 0, "filtered_low_specificity": 1, "retained": 3}
    assert {r[0] for r in contamination.decontaminated(counts, masks).select("species").collect()} == {"s0", "s1", "s3"}
    kept = contamination.species_masks(counts, "prevalence", 0.5, min_cells=2, specificity_threshold=0.0).where("keep").collect()
    assert [r["species"] for r in kept] == ["s2"]
    with pytest.raises(ValueError):
        contamination.species_masks(counts, "binomial")


def test_ambient_profile_and_correction(spark):
    counts = long_form(spark, F8)
    profile = contamination.ambient_profile(counts)
    assert rows(profile) == [("s0", 0.0), ("s1", 0.0), ("s2", 1.0), ("s3", 0.0)]
    corrected = contamination.ambient_corrected(counts, profile)
    assert dict(corrected.dtypes)["n"] == "float"
    assert all(r["n"] == (0.0 if r["species"] == "s2" else {"s0": 10, "s1": 8, "s3": 5}[r["species"]]) for r in corrected.collect())
    empty = counts.limit(0)
    assert contamination.ambient_profile(empty).count() == 0
    same = contamination.ambient_corrected(counts, contamination.ambient_profile(empty))
    assert rows(same.select("species", "barcode", F.col("n").cast("long"))) == rows(counts)


def test_doublets(spark):
    counts = long_form(spark, F8)
    assert contamination.doublets(counts).count() == 0
    assert [r[0] for r in rows(contamination.doublets(counts, 1))] == ["c0", "c1", "c8"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 6), min_size=4, max_size=4), min_size=1, max_size=4))
def test_sparse_scores_equal_dense(spark, dense):
    x = np.array(dense)
    x = x[:, x.sum(0) > 0]
    if not x.size or not x.sum():
        return
    got = {r["species"]: r for r in contamination.specificity_scores(long_form(spark, x.tolist())).collect()}
    for i, row in enumerate(x):
        if row.sum():
            n, ordered = len(row), np.cumsum(np.sort(row))
            gini = (n + 1 - 2 * ordered.sum() / ordered[-1]) / n
            assert got[f"s{i}"]["gini"] == pytest.approx(gini) and got[f"s{i}"]["cv"] == pytest.approx(row.std() / row.mean(), abs=1e-7)


F9 = [[10, 0, 5], [0, 8, 0], [1, 1, 2]]


def test_quality_summary(spark):
    counts = long_form(spark, F9, ["E.coli", "S.aureus", "B.subtilis"], ["cell_A", "cell_B", "cell_C"])
    dims = quantify.species_dim(counts), quantify.cell_dim(counts)
    got = {r["metric"]: (r["mean"], r["median"], r["max"], r["min"]) for r in qc.qc_summary(counts, *dims).collect()}
    assert got == {"microbes_per_cell": (2, 2, 2, 2), "reads_per_cell": (9, 9, 11, 7), "cells_per_microbe": (2, 2, 3, 1), "reads_per_microbe": (9, 8, 15, 4)}
    shape = qc.matrix_summary(counts, *dims).first()
    assert (shape["total"], shape["nnz"], round(shape["sparsity"], 4)) == (27, 6, 0.3333)
    none = counts.limit(0)
    empty = qc.matrix_summary(none, quantify.species_dim(none), quantify.cell_dim(none)).first()
    assert (empty["total"], empty["sparsity"]) == (0, 0.0)


def test_dimensions_and_matrix(spark):
    counts = long_form(spark, F9, ["b", "a", "C"], ["y", "x", "z"])
    assert rows(quantify.species_dim(counts)) == [("C", 0), ("a", 1), ("b", 2)]
    many = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("barcode")).repartition(7)
    dim = quantify.indexed(many, "barcode", "i").orderBy("i").collect()
    assert [(int(r["barcode"]), r["i"]) for r in dim] == [(i, i) for i in range(1000)]
    coo = rows(matrix.coo(counts, quantify.species_dim(counts), quantify.cell_dim(counts)))
    assert coo == [(1, 1, 1), (1, 2, 8), (2, 1, 1), (2, 3, 10), (3, 1, 2), (3, 3, 5)]
    wide = {r["species"]: (r["x"], r["y"], r["z"]) for r in matrix.dense(counts, ["x", "y", "z"]).collect()}
    assert wide == {"a": (8, 0, 0), "b": (0, 10, 5), "C": (1, 1, 2)}


def test_genomes(spark):
    summary = spark.createDataFrame([("latest", "Complete Genome", "https://x/GCF_2"), ("latest", "Scaffold", "https://x/GCF_3"), ("replaced", "Complete Genome", "https://x/GCF_4"), ("latest", "Complete Genome", "https://x/GCF_1")], "version_status string, assembly_level string, ftp_path string")
    assert [r["accession"] for r in genomes.genome_list(summary, limit=5).collect()] == ["GCF_1", "GCF_2"]
    paf = spark.createDataFrame([("c1", 95, 100), ("c2", 94, 100), ("c1", 10, 100), ("c3", 0, 0)], "query_name string, matches int, alignment_length int")
    assert rows(genomes.host_like_contigs(paf)) == [("c1",)]
    own = spark.createDataFrame([("c1", "A"), ("c2", "C")], "contig string, sequence string")
    assert rows(genomes.without_contigs(own, genomes.host_like_contigs(paf))) == [("c2", "C")]


def test_kmers_and_alignment(spark):
    rng = np.random.default_rng(5)
    genome = {f"g{i}": "".join(rng.choice(list("ACGT"), 70_000 if i == 0 else 3_000)) for i in range(3)}
    refs = spark.createDataFrame(list(genome.items()), "reference string, sequence string")
    index = {(r["reference"], r["position"]): r["kmer"] for r in kmer.exploded(refs, 21, "reference").collect()}
    assert len(index) == sum(len(g) - 20 for g in genome.values())
    assert all(genome[g][p : p + 21] == k for (g, p), k in list(index.items())[::97])
    own, truth = [], {}
    for i in range(120):
        g, reverse, errors = f"g{i % 3}", bool(i % 2), i % 4
        at = int(rng.integers(0, len(genome[g]) - 100))
        s = list(genome[g][at : at + 100])
        for p in rng.choice(100, errors, replace=False):
            s[p] = {"A": "C", "C": "G", "G": "T", "T": "A"}[s[p]]
        s = "".join(s)
        own.append((f"r{i}", i, s[::-1].translate(str.maketrans("ACGT", "TGCA")) if reverse else s))
        truth[f"r{i}"] = (g, at, reverse, errors)
    got = {r["read_id"]: (r["reference_name"], r["reference_start"], r["reverse"], r["mismatches"]) for r in kmer.align(spark.createDataFrame(own, "read_id string, ordinal long, sequence string"), refs).collect()}
    assert len(got) >= 119 and all(truth[k] == v for k, v in got.items())
    joined = {}
    for r in kmer.pieces(refs).orderBy("piece").collect():
        joined[r["reference"]] = joined.get(r["reference"], "") + r["bases"]
    assert joined == genome
    ends = [("x", 0, "TTTTT" + genome["g1"][:95]), ("y", 0, genome["g1"][-90:] + "A" * 10), ("z", 0, genome["g0"][4000:4300])]
    got = {r["read_id"]: (r["reference_start"], r["mismatches"], r["mapq"]) for r in kmer.align(spark.createDataFrame(ends, "read_id string, ordinal long, sequence string"), refs, max_places=50).collect()}
    assert got["x"][:2] == (0, 5) and got["y"][:2] == (2910, 10) and got["z"] == (4000, 0, 60)
    assert kmer.vote(spark.createDataFrame([("a", "ACG"), ("b", None)], "read_id string, sequence string"), refs).count() == 0


def test_lengths(spark):
    d = spark.createDataFrame([("A" * n,) for n in (10, 50, 70, 100, 101)], "sequence string")
    assert reads.length_filtered(d, 50).count() == 4
    assert reads.length_filtered(d, 50, 100).count() == 3


def test_dense_rows_hold_every_cell(spark):
    """More cells than a query could name, with some that only other species have, against a plain matrix."""
    x = np.zeros((3, 257), int)
    x[0, ::7], x[1, 256], x[2, 1] = np.arange(1, 38), 5, 2
    cells = [f"c{j:03}" for j in range(257)]
    counts = spark.createDataFrame([(f"s{i}", cells[j], int(x[i, j])) for i in range(3) for j in range(257) if x[i, j]], "species string, barcode string, n long")
    dims = spark.createDataFrame([(c, j) for j, c in enumerate(cells)], "barcode string, cell_idx long")
    assert {r["species"]: r["n"] for r in matrix.dense_rows(counts, dims).collect()} == {f"s{i}": x[i].tolist() for i in range(3)}


def test_kmers_are_taken_by_compiled_code(spark):
    """k-mers at their places, over part borders and of letters of several bytes; none is made by an interpreted lambda."""
    from germlight.operators import kmer

    text = "".join("ab\u00e9\U0001f600"[i * i % 7 % 4] for i in range(kmer.PIECE + 2 * kmer.STEPS[0] + 77))
    rows = spark.createDataFrame([("a", text), ("b", "xyz"), ("c", "xy"), ("d", None)], "id string, sequence string")
    found = kmer.exploded(rows, 3, "id")
    got = [tuple(r) for r in found.sort("id", "position").collect()]
    assert got == [*(("a", i, text[i : i + 3]) for i in range(len(text) - 2)), ("b", 0, "xyz")]
    last = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first = next(i for i, line in enumerate(last) if "Generate" in line)
    assert "sequence(0" in last[first] and "lambda" not in last[first]


def test_votes_take_apart_only_parts_that_may_share(spark):
    """Votes equal those by all k-mers, for any k; reads without anything of a reference are left out before their k-mers are made."""
    import random

    from germlight.operators import kmer

    random.seed(2)
    some = lambda n: "".join(random.choices("AC", k=n))
    refs = [(f"r{i}", some(30)) for i in range(4)]
    own = [(i, some(random.randint(0, 60)) + random.choice(refs)[1][random.randint(0, 9) :] + some(5)) for i in range(20)] + [(20, "GT" * 40)]
    for k in (1, 2, 5, 9, 14):
        many = lambda s: {s[i : i + k] for i in range(len(s) - k + 1)}  # noqa: E731,B023
        votes = [(i, *min((-len(many(s) & many(t)), name) for name, t in refs)) for i, s in own]
        found = kmer.vote(spark.createDataFrame(own, "read_id long, sequence string"), spark.createDataFrame(refs, "reference string, sequence string"), k)
        assert sorted((r["read_id"], -r["votes"], r["reference"]) for r in found.collect()) == [v for v in votes if v[1]]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_chance_kmers_are_no_second_place(spark):
    """A genome with one 21-mer of a read takes nothing off its mapping quality, one with most of it does, and a copy of the place takes all."""
    rng = np.random.default_rng(11)
    dna = lambda n: "".join(rng.choice(list("ACGT"), n))
    a, b, c = dna(300), dna(300), dna(300)
    refs = [("a", a), ("b", b), ("c", c), ("chance", dna(50) + a[100:121] + dna(50)), ("near", b[100:172] + dna(60)), ("twin", dna(40) + c[100:200])]
    own = [("a", 0, a[100:200]), ("b", 1, b[100:200]), ("c", 2, c[100:200])]
    got = {r["read_id"]: (r["reference_name"], r["mismatches"], r["mapq"]) for r in kmer.align(spark.createDataFrame(own, "read_id string, ordinal long, sequence string"), spark.createDataFrame(refs, "reference string, sequence string")).collect()}
    assert got == {"a": ("a", 0, 60), "b": ("b", 0, 21), "c": ("c", 0, 0)}


def test_equal_rows_of_a_read_stay_as_many(spark):
    """Also where a read lies over two pieces of its reference."""
    genome = "".join(np.random.default_rng(12).choice(list("ACGT"), 2 * kmer.BASES))
    own = [("p", 0, genome[50:150])] * 3 + [("q", 1, genome[kmer.BASES - 40 : kmer.BASES + 60])] * 2 + [("r", 2, genome[:100])]
    got = rows(kmer.align(spark.createDataFrame(own, "read_id string, ordinal long, sequence string"), spark.createDataFrame([("g", genome)], "reference string, sequence string")).select("read_id", "reference_start", "mismatches", "mapq"))
    assert got == [("p", 50, 0, 60)] * 3 + [("q", kmer.BASES - 40, 0, 60)] * 2 + [("r", 0, 0, 60)]
