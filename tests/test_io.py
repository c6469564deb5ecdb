"""Sources, sinks, options, and the whole pipeline on a seeded synthetic BAM."""

import gzip
import json
import os
import random

import pytest
from bam_writer import record, write_bam
from pyspark.sql import functions as F

from germlight import cli, pipeline, sources
from germlight.operators import quantify
from germlight.options import Options, _sections, from_config
from germlight.sinks import matrix as matrix_sink
from germlight.sinks.bam import END, _block
from germlight.sinks import report, text
from germlight.sources import fastq
from germlight.sources.assembly import read_assembly_summary, read_paf
from germlight.sources.fasta import read_fasta

REFS = [("chr1", 100_000), ("E.coli", 50_000)]


def reads_of(n, seed=3):
    rng, out = random.Random(seed), []
    for i in range(n):
        size = rng.randrange(20, 150)
        s = "".join(rng.choice("ACGTN") for _ in range(size))
        flag = rng.choice([0, 16, 4, 256, 2048])
        barcode = rng.choice(["AAAA-1", "-x", "", "CCCC", None])
        tags = {"XA": ("A", "q"), "XB": ("B", ("S", (1, 2, 3))), "XF": ("f", 1.5), "NM": ("C", 3)}
        tags |= {} if barcode is None else {"CB": barcode}
        tags |= {"UB": f"U{i % 7}"} if i % 3 else {}
        out.append({"name": f"read_{i:08d}", "flag": flag, "ref": -1 if flag & 4 else i % 2, "pos": -1 if flag & 4 else rng.randrange(40_000), "mapq": rng.randrange(61), "cigar": [(size, "M")], "sequence": s, "quality": None if i % 5 == 0 else "".join(chr(33 + rng.randrange(40)) for _ in range(size)), "tags": tags})
    return out


@pytest.fixture(scope="module")
def bam(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bam") / "x.bam")
    data = reads_of(3000)
    write_bam(path, REFS, [record(**r) for r in data])
    return path, data


@pytest.mark.parametrize("split", [1 << 26, 20_000, 5_000])
def test_bam_round_trip(spark, bam, split):
    path, data = bam
    sources.register(spark)
    df = spark.read.format("bam").option("split", split).load(path)
    assert split > 1 << 20 or df.rdd.getNumPartitions() > 3
    got = sorted(df.collect(), key=lambda r: r["read_id"])
    assert len(got) == len(data) and len({r["ordinal"] for r in got}) == len(data)
    for r, d in zip(got, data):
        mapped = not d["flag"] & 4
        barcode = d["tags"].get("CB")
        assert (r["read_id"], r["flag"], r["mapq"], r["sequence"]) == (d["name"], d["flag"], d["mapq"], d["sequence"])
        assert r["quality"] == (d["quality"] or "")
        assert (r["reference_name"], r["reference_start"], r["cigar"]) == ((REFS[d["ref"]][0], d["pos"], f"{len(d['sequence'])}M") if mapped else (None, None, None))
        assert (r["barcode"], r["umi"]) == (None if barcode is None else barcode.split("-")[0], d["tags"].get("UB"))
    assert [r["read_id"] for r in sorted(got, key=lambda r: r["ordinal"])] == [d["name"] for d in data]


def test_bam_options(spark, bam):
    path, data = bam
    sources.register(spark)
    few = spark.read.format("bam").options(candidates="true", mapq="30", sequence="false").load(path)
    expected = [d for d in data if not d["flag"] & 0x900 and (d["flag"] & 4 or d["mapq"] < 30)]
    assert few.count() == len(expected) and few.where("sequence is not null").count() == 0
    tagged = spark.read.format("bam").option("barcode_tag", "NM").option("umi_tag", "XB").load(path).first()
    assert (tagged["barcode"], tagged["umi"]) == ("3", "1,2,3")


def test_bam_faults(spark, bam, tmp_path):
    path, _ = bam
    sources.register(spark)
    whole = open(path, "rb").read()
    for name, content in (("cut.bam", whole[: len(whole) // 2]), ("none.bam", b"plain text, no BAM at all")):
        (tmp_path / name).write_bytes(content)
        with pytest.raises(Exception, match="ends within|not a"):
            spark.read.format("bam").load(str(tmp_path / name)).count()
    write_bam(str(tmp_path / "empty.bam"), REFS, [])
    assert spark.read.format("bam").load(str(tmp_path / "empty.bam")).count() == 0


FASTQ = "".join(f"@r{i} x\n{'ACGT' * (i % 5 + 1)}\n+\n{'@III' * (i % 5 + 1)}\n" for i in range(500))


@pytest.mark.parametrize("split", [1 << 26, 1000, 333])
def test_fastq(spark, tmp_path, split):
    sources.register(spark)
    (tmp_path / "a.fastq").write_text(FASTQ[:-1])  # without a last line end
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as out:
        out.write(FASTQ)
    for name in ("a.fastq", "b.fastq.gz"):
        df = spark.read.format("fastq").option("split", split).load(str(tmp_path / name))
        got = sorted((tuple(r) for r in df.collect()), key=lambda r: int(r[0].split()[0][1:]))
        assert got == [(f"r{i} x", "ACGT" * (i % 5 + 1), "+", "@III" * (i % 5 + 1)) for i in range(500)]
    (tmp_path / "bad.fastq").write_text("r1\nACGT\n+\nIIII\n")
    with pytest.raises(Exception, match="instead of @"):
        spark.read.format("fastq").load(str(tmp_path / "bad.fastq")).count()


@pytest.mark.parametrize("block", [40, 700, 60_000])
def test_fastq_blocks_split_anywhere(tmp_path, block):
    """Block borders fall on every place of a record, also right before one; each record is read once, whatever the spans."""
    data = FASTQ.encode()[:-1]
    cut = [*range(0, len(data), block), data.index(b"@r7 "), data.index(b"@r8 "), len(data)]
    cut = sorted(set(cut))
    pieces = [_block(data[a:b]) for a, b in zip(cut, cut[1:])]
    pieces.insert(len(pieces) // 2, END)  # an empty block amid the others, as files put together have it
    path = str(tmp_path / "x.fastq.gz")
    (tmp_path / "x.fastq.gz").write_bytes(b"".join([*pieces, END]))
    expected = [(f"r{i} x", "ACGT" * (i % 5 + 1), "+", "@III" * (i % 5 + 1)) for i in range(500)]
    for split in (1 << 26, 5_000, 997, 130):
        reader = fastq.FastqReader(path, split)
        got = [row for span in reader.partitions() for batch in reader.read(span) for row in zip(*(c.to_pylist() for c in batch.columns))]
        assert got == expected


def test_fastq_blocks_cut_off(tmp_path):
    whole = _block(FASTQ.encode())
    (tmp_path / "x.fastq.gz").write_bytes(whole[:-30])
    reader = fastq.FastqReader(str(tmp_path / "x.fastq.gz"), 1 << 26)
    with pytest.raises(ValueError, match="ends within"):
        [list(reader.read(span)) for span in reader.partitions()]


def test_text_files(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">one first\nACGT\nacg\n>two\r\nTT\r\nAA\r\n>three\n")
    got = {r["name"]: (r["header"], r["sequence"]) for r in read_fasta(spark, str(tmp_path / "g.fa")).collect()}
    assert got == {"one": ("one first", "ACGTACG"), "two": ("two", "TTAA"), "three": ("three", "")}
    line = ["x"] * 10 + ["latest", "Complete Genome"] + ["x"] * 7 + ["https://h/GCF_1"]
    (tmp_path / "s.txt").write_text("# comment\n" + "\t".join(line) + "\nshort\tline\n")
    assert [tuple(r) for r in read_assembly_summary(spark, str(tmp_path / "s.txt")).collect()] == [("latest", "Complete Genome", "https://h/GCF_1")]
    (tmp_path / "a.paf").write_text("q\t10\t0\t10\t+\tt\t20\t0\t10\t9\t10\t60\ttp:A:P\n")
    assert read_paf(spark, str(tmp_path / "a.paf")).first()["matches"] == 9


def test_text_sinks(spark, tmp_path):
    d = spark.createDataFrame([("r1", "ACGT", "IIII", "B"), ("r2", None, None, ""), ("r3", "A", "I", "A")], "read_id string, sequence string, quality string, barcode string").coalesce(1)
    sources.register(spark)
    for compress in (False, True):
        path = str(tmp_path / f"fq{compress}")
        text.write_fastq(d, path, compress)
        assert any(f.endswith(".gz") for f in os.listdir(path)) == compress
    plain = next(f for f in os.listdir(tmp_path / "fqFalse") if f.startswith("part"))
    assert (tmp_path / "fqFalse" / plain).read_text() == "@r1\nACGT\n+\nIIII\n@r2\n\n+\n\n@r3\nA\n+\nI\n"
    text.write_fasta(d, str(tmp_path / "fa"))
    assert read_fasta(spark, str(tmp_path / "fa")).count() == 3
    text.write_barcodes(d, str(tmp_path / "bc"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "bc")).collect()] == ["A", "B"]
    text.write_cell_metadata(d.select("barcode", "read_id"), str(tmp_path / "meta"))
    assert spark.read.csv(str(tmp_path / "meta"), sep="\t", header=True).columns == ["barcode", "read_id"]
    text.write_sorted_alignments(d.select("read_id", F.lit("c").alias("reference_name"), F.lit(1).alias("reference_start")), str(tmp_path / "aln"))
    assert spark.read.parquet(str(tmp_path / "aln")).count() == 3


GOLDEN_ROW = [9, 7, 8, 9, 11, 11, 8, 7, 7, 7]


def test_matrix_formats(spark, tmp_path):
    counts = spark.createDataFrame([("E.coli", f"CELL{i:04d}", n) for i, n in enumerate(GOLDEN_ROW)], "species string, barcode string, n long")
    matrix_sink.write_matrix(counts, str(tmp_path), default_names=True)
    assert (tmp_path / "mtx/matrix.mtx").read_text() == "%%MatrixMarket matrix coordinate integer general\n%\n10 1 10\n" + "".join(f"{i + 1} 1 {n}\n" for i, n in enumerate(GOLDEN_ROW))
    assert (tmp_path / "mtx/barcodes.tsv").read_text() == "".join(f"cell_{i}\n" for i in range(10))
    assert (tmp_path / "mtx/features.tsv").read_text() == "species_0\n"
    assert (tmp_path / "germlight_matrix.tsv").read_text() == "\t" + "\t".join(f"cell_{i}" for i in range(10)) + "\nspecies_0\t" + "\t".join(map(str, GOLDEN_ROW)) + "\n"
    matrix_sink.write_mtx(counts, str(tmp_path / "turned"), orientation="features_x_cells")
    assert (tmp_path / "turned/matrix.mtx").read_text().splitlines()[2:4] == ["1 10 10", "1 1 9"]
    assert (tmp_path / "turned/features.tsv").read_text() == "E.coli\n"
    with pytest.raises(ValueError):
        matrix_sink.write_matrix(counts, str(tmp_path), ("other",))
    try:
        import anndata  # noqa: F401
    except ImportError:
        with pytest.raises(RuntimeError, match="anndata"):
            matrix_sink.write_h5ad(counts, str(tmp_path / "x.h5ad"))


def test_reports(spark, tmp_path):
    counts = spark.createDataFrame([("E.coli", "a", 10), ("E.coli", "c", 5), ("S", "b", 8), ("B", "a", 1), ("B", "b", 1), ("B", "c", 2)], "species string, barcode string, n long")
    said = report.write_qc_report(counts, quantify.species_dim(counts), quantify.cell_dim(counts), str(tmp_path / "qc.txt"))
    assert "Total counts: 27" in said and "Sparsity: 0.3333" in said and "Median: 8.00" in said
    none = counts.limit(0)
    assert "Total counts: 0" in report.qc_report(none, quantify.species_dim(none), quantify.cell_dim(none))
    import numpy as np

    report.write_stats({"a": np.int64(3), "shape": (1, 10), "f": np.float64(0.5)}, str(tmp_path / "s.json"))
    assert (tmp_path / "s.json").read_text() == '{\n  "a": 3,\n  "shape": [\n    1,\n    10\n  ],\n  "f": 0.5\n}'


CONFIG = "host_filter:\n  mapq_threshold: 20\n  identity_threshold: 90.5\nquantification:\n  method: umi\n  umi_dedup_method: hamming\ncontamination:\n  min_cells: 5  # cells\noutput:\n  formats:\n    - mtx\n    - tsv\n"


def test_options(tmp_path):
    (tmp_path / "c.yaml").write_text(CONFIG)
    args = cli.parser().parse_args(["-i", "x", "-o", "y", "-c", str(tmp_path / "c.yaml"), "--host-mapq", "25"])
    o = cli.options_of(args)
    assert (o.host_mapq, o.host_identity, o.umi_dedup_method, o.min_cells, o.formats, o.ambient_cutoff) == (25, 90.5, "hamming", 5, ("mtx", "tsv"), 0.1)
    assert from_config(_sections(CONFIG)) == from_config(_sections(CONFIG.replace("    - mtx\n    - tsv", "").replace("formats:", "formats: [mtx, tsv]")))
    for bad in ({"quant_method": "x"}, {"contamination_method": "binomial"}, {"nothing": 1}):
        with pytest.raises(ValueError):
            Options().updated(bad)
    assert cli.options_of(cli.parser().parse_args(["-i", "x", "-o", "y"])) == Options()


def test_pipeline(spark, tmp_path):
    rng = random.Random(9)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    host, microbes = dna(20_000), {"E.coli": dna(8_000), "S.aureus": dna(8_000)}
    (tmp_path / "host.fa").write_text(f">chr1\n{host}\n")
    (tmp_path / "microbes.fa").write_text("".join(f">{k}\n{v}\n" for k, v in microbes.items()))
    records, truth, n_candidates, n_host = [], set(), 0, 0
    for i in range(400):
        cell, umi = f"CELL{i % 10:04d}", f"UMI{rng.randrange(40):04d}"
        kind = rng.random()
        if kind < 0.5:  # host, well mapped
            at = rng.randrange(19_900)
            r = dict(ref=0, pos=at, mapq=60, sequence=host[at : at + 100])
        elif kind < 0.6:  # host, badly mapped: the alignment to the host removes it
            at = rng.randrange(19_900)
            r, n_candidates, n_host = dict(ref=0, pos=at, mapq=3, sequence=host[at : at + 100]), n_candidates + 1, n_host + 1
        else:
            name = rng.choice(sorted(microbes))
            at = rng.randrange(7_900)
            r = dict(flag=4, ref=-1, pos=-1, mapq=0, sequence=microbes[name][at : at + 100])
            n_candidates += 1
            truth.add((name, cell, umi))
        records.append(record(f"read_{i:08d}", cigar=[(100, "M")], quality="I" * 100, tags={"CB": f"{cell}-1", "UB": umi}, **r))
    path = str(tmp_path / "x.bam")
    write_bam(path, [("chr1", 20_000)], records)
    out = tmp_path / "out"
    assert cli.main(["-i", path, "-o", str(out), "--host-ref", str(tmp_path / "host.fa"), "--microbe-ref", str(tmp_path / "microbes.fa"), "--skip-contamination-filter", "--log-level", "ERROR"]) == 0
    stats = json.loads((out / "germlight_stats.json").read_text())
    assert (stats["bam_total_reads"], stats["total_reads"], stats["host_filtered"], stats["microbial_aligned"]) == (400, n_candidates, n_candidates - n_host, n_candidates - n_host)
    counts: dict = {}
    for name, cell, _ in truth:
        counts[name, cell] = counts.get((name, cell), 0) + 1
    lines = [x.split("\t") for x in (out / "germlight_matrix.tsv").read_text().splitlines()]
    got = {(row[0], c): int(n) for row in lines[1:] for c, n in zip(lines[0][1:], row[1:]) if n != "0"}
    assert got == counts
    filtered = pipeline.run(spark, path, str(tmp_path / "out2"), Options(contamination_method="both", specificity_threshold=0.0), microbe_ref=str(tmp_path / "microbes.fa"))
    assert filtered["contamination"]["input_species"] == 2
    assert cli.main(["-i", str(tmp_path / "none.bam"), "-o", str(out), "--microbe-ref", "x", "--log-level", "CRITICAL"]) == 1


def test_streaming_equals_batch(spark, bam, tmp_path):
    from germlight.streaming import reads as streaming

    sources.register(spark)
    batch = spark.read.format("bam").load(bam[0])
    batch.repartition(4).write.parquet(str(tmp_path / "in"))
    hits = spark.createDataFrame([("read_00000004", 1, True), ("read_00000006", 1, False)], "read_id string, ordinal long, is_host boolean")
    stream = streaming.without_host(streaming.candidates(streaming.read_stream(spark, str(tmp_path / "in"))), hits)
    query = streaming.to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    from germlight.operators import host, reads

    expected = host.without_host(reads.candidate_reads(batch), hits)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r[0] for r in got.select("read_id").collect()) == sorted(r[0] for r in expected.select("read_id").collect())


def test_reference_database(spark, tmp_path):
    from germlight import api

    (tmp_path / "a.fa").write_text(">c1 x\nACGTACGTAC\n>c2\nTTTTGGGGCC\n")
    with gzip.open(tmp_path / "b.fa.gz", "wt") as out:
        out.write(">c3\nGATTACAGAT\n")
    both = api.combined(spark, str(tmp_path / "a.fa"), str(tmp_path / "b.fa.gz"))
    paf = spark.createDataFrame([("c2", 99, 100)], "query_name string, matches int, alignment_length int")
    api.write_combined(api.host_free(both, paf), str(tmp_path / "all"))
    assert {r["header"] for r in read_fasta(spark, str(tmp_path / "all")).collect()} == {"c1 x", "c3"}
    api.write_index(both, str(tmp_path / "index"), k=8)
    assert spark.read.parquet(str(tmp_path / "index")).count() == 9
    assert api.length_stats(both, 5, 9).first().asDict() == {"processed": 3, "written": 0}


def test_native_databases_serve_the_command_line(spark, tmp_path):
    """build_db's index and taxonomy, read by runs with the chain and lca aligners; the log lies beside the output."""
    import random

    from bam_writer import record, write_bam

    from germlight import build_db

    rng = random.Random(3)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    genomes = {"Gut one": dna(3000), "Gut two": dna(3000), "Sea one": dna(3000)}
    (tmp_path / "m.fa").write_text("".join(f">{n.replace(' ', '_')}\n{s}\n" for n, s in genomes.items()))
    (tmp_path / "nodes.tsv").write_text("1\t1\troot\troot\n2\t1\tgenus\tGut\n3\t1\tgenus\tSea\n4\t2\tspecies\tGut one\n5\t2\tspecies\tGut two\n6\t3\tspecies\tSea one\n")
    (tmp_path / "ids.tsv").write_text("Gut_one\t4\nGut_two\t5\nSea_one\t6\n")
    db = str(tmp_path / "db")
    assert build_db.main(["-o", db, "--fasta", str(tmp_path / "m.fa"), "--taxonomy", str(tmp_path / "nodes.tsv"), "--taxids", str(tmp_path / "ids.tsv")]) == 0
    rows, want = [], {}
    for i in range(60):
        name = list(genomes)[i % 3]
        at = rng.randrange(2800)
        s = genomes[name][at : at + 50] + ("" if i % 2 else "ACG") + genomes[name][at + 50 : at + 120]
        rows.append(record(f"r{i}", flag=4, ref=-1, pos=-1, mapq=0, sequence=s, quality="I" * len(s), tags={"CB": f"C{i % 4}", "UB": f"U{i}"}))
        want[name, f"C{i % 4}"] = want.get((name, f"C{i % 4}"), 0) + 1
    write_bam(str(tmp_path / "reads.bam"), [("chr1", 1000)], rows)
    for aligner, given, turn in (("chain", ["--minimap2-index", db + "/aligner"], lambda s: s.replace(" ", "_")), ("lca", ["--kraken-db", db + "/lca"], lambda s: s)):
        out = tmp_path / aligner
        assert cli.main(["-i", str(tmp_path / "reads.bam"), "-o", str(out), "--aligner", aligner, *given, "--skip-contamination-filter", "--log-level", "error"]) == 0
        lines = (out / "count_matrix.tsv" if (out / "count_matrix.tsv").exists() else next(out.glob("*.tsv"))).read_text().splitlines()
        cells = lines[0].split("\t")[1:]
        got = {(x.split("\t")[0], c): int(float(n)) for x in lines[1:] for c, n in zip(cells, x.split("\t")[1:]) if float(n)}
        assert got == {(turn(s), c): n for (s, c), n in want.items()}, aligner
        assert (out / "germlight.log").exists()
    assert cli.main(["-i", str(tmp_path / "reads.bam"), "-o", str(tmp_path / "no"), "--aligner", "lca", "--log-level", "CRITICAL"]) == 1
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["-i", "x", "-o", "y", "--log-level", "loud"])


def test_extract(spark, bam, tmp_path, capsys):
    from germlight import extract

    path, data = bam
    expected = [d for d in data if not d["flag"] & 0x900 and (d["flag"] & 4 or d["mapq"] < 20)]
    assert extract.main(["-i", path, "-o-fastq", str(tmp_path / "fq"), "-o-fasta", str(tmp_path / "fa"), "-o-barcodes", str(tmp_path / "bc"), "-mapq", "20", "-compress", "-parallel"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["candidate_reads"] == len(expected)
    sources.register(spark)
    assert sorted(r["name"] for r in spark.read.format("fastq").load(str(tmp_path / "fq")).collect()) == sorted(d["name"] for d in expected)
    assert read_fasta(spark, str(tmp_path / "fa")).count() == len(expected)
    cells = {d["tags"]["CB"].split("-")[0] for d in expected if d["tags"].get("CB", "-x").split("-")[0]}
    assert {r[0] for r in spark.read.text(str(tmp_path / "bc")).collect()} == cells


def test_build_db(spark, tmp_path):
    from germlight import build_db

    (tmp_path / "a.fa").write_text(">c1\nACGTACGTAC\n>c2\nTTTTGGGGCC\n")
    (tmp_path / "hits.paf").write_text("c2\t10\t0\t10\t+\tt\t20\t0\t10\t10\t10\t60\n")
    line = ["x"] * 10 + ["latest", "Complete Genome"] + ["x"] * 7 + ["https://h/GCF_1"]
    (tmp_path / "s.txt").write_text("\t".join(line) + "\n")
    out = str(tmp_path / "db")
    assert build_db.main(["-o", out, "--fasta", str(tmp_path / "a.fa"), "--host-paf", str(tmp_path / "hits.paf"), "--summary", str(tmp_path / "s.txt"), "-k", "5"]) == 0
    assert [r["name"] for r in read_fasta(spark, out + "/combined").collect()] == ["c1"]
    assert spark.read.parquet(out + "/index").count() == 6
    assert spark.read.text(out + "/genomes").first()[0] == "https://h/GCF_1\tGCF_1"
    with pytest.raises(SystemExit):
        build_db.main(["-o", out])


def test_external_program(spark, tmp_path):
    from germlight.operators import external
    from germlight.sources.sam import parse_sam

    tool = tmp_path / "tool"
    tool.write_text('#!/bin/sh\nprintf "@HD\\tVN:1.6\\n"\nfor last; do :; done\nawk \'NR % 4 == 1 { name = substr($0, 2) } NR % 4 == 2 { printf "%s\\t0\\tE.coli\\t5\\t60\\t4M\\t*\\t0\\t0\\t%s\\t*\\tNM:i:1\\n", name, $0 }\' "$last"\n')
    tool.chmod(0o755)
    own = spark.createDataFrame([(f"r{i}", "ACGT", "IIII") for i in range(50)], "read_id string, sequence string, quality string").repartition(3)
    got = parse_sam(external.lines_of(own, [str(tool), "reference"])).collect()
    assert sorted(r["read_id"] for r in got) == sorted(f"r{i}" for i in range(50)) and {(r["reference_start"], r["mismatches"]) for r in got} == {(4, 1)}
    assert len({r["ordinal"] for r in got}) == 50
    broken = tmp_path / "broken"
    broken.write_text("#!/bin/sh\necho no index >&2\nexit 3\n")
    broken.chmod(0o755)
    for command, said in (([str(broken)], "ended with 3"), ([str(tmp_path / "none")], "not on this executor's PATH")):
        with pytest.raises(Exception, match=said):
            external.lines_of(own, command).count()


def test_validation(tmp_path):
    (tmp_path / "x.bam").write_bytes(b"")
    path = str(tmp_path / "x.bam")
    pipeline.validate(Options(), path, "ref.fa", None)
    for options, where, ref, said in ((Options(), path + "y", "r", "exist"), (Options(), path, None, "reference"), (Options(aligner="kraken2"), path, None, "database")):
        with pytest.raises(ValueError, match=said):
            pipeline.validate(options, where, ref, None)


def test_fasta_headers_may_hold_the_mark(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a one>two\r\nacg\r\nt\r\n>b\nAC>\n>c x\n\n")
    from germlight.sources.fasta import read_fasta

    rows = sorted((r["name"], r["header"], r["sequence"]) for r in read_fasta(spark, str(tmp_path / "x.fa")).collect())
    assert rows == [("a", "a one>two", "ACGT"), ("b", "b", "AC>"), ("c", "c x", "")]


def test_last_line_wins_over_files_of_any_size(spark, tmp_path):
    """The larger file is dealt out first, but the later name holds the last line."""
    from germlight.operators.dedup import last_wins
    from germlight.sources.kraken import read_kraken

    folder = tmp_path / "k"
    folder.mkdir()
    (folder / "a.txt").write_text("".join(f"C\tr{i % 50}\t1\t100\troot;early\n" for i in range(5000)))
    (folder / "b.txt").write_text("".join(f"C\tr{i}\t2\t100\troot;late\n" for i in range(50)))
    found = last_wins(read_kraken(spark, str(folder)), "read_id").collect()
    assert len(found) == 50 and {r["species"] for r in found} == {"late"}


def test_chunks_have_their_size(spark):
    from germlight.operators.reads import chunks

    sizes = {r["chunk"]: r["count"] for r in chunks(spark.range(0, 2503, 1, 7), 100).groupBy("chunk").count().collect()}
    assert sizes == {i: 100 for i in range(25)} | {25: 3}


def test_bam_sink_in_coordinate_order(spark, tmp_path):
    from germlight.sinks.bam import write_bam
    from germlight.sources import register

    rows = [(f"r{i}", 0, "c1" if i % 3 else "c0", i * 7 % 100, 60, "3M1I2S", "ACGTNA", "IIII#I", "AC-1", None) for i in range(200)] + [("u", 4, None, None, 0, None, "ACG", None, None, "U")]
    schema = "read_id string, flag int, reference_name string, reference_start int, mapq int, cigar string, sequence string, quality string, barcode string, umi string"
    names = write_bam(spark.createDataFrame(rows, schema).repartition(5), str(tmp_path / "b"), [("c1", 500), ("c0", 500)], coordinate_sorted=True)
    register(spark)
    got = [spark.read.format("bam").load(f"{tmp_path}/b/{n}").orderBy("ordinal").collect() for n in names]
    got = [r for part in got for r in part]
    places = [(2 if r["reference_name"] is None else r["reference_name"] == "c0", r["reference_start"] or 0) for r in got]
    assert places == sorted(places) and len(got) == 201 and got[-1]["read_id"] == "u" and got[-1]["umi"] == "U"
    assert {(r["cigar"], r["sequence"], r["quality"], r["barcode"]) for r in got[:-1]} == {("3M1I2S", "ACGTNA", "IIII#I", "AC")}
    assert sorted(x.name for x in (tmp_path / "b").iterdir()) == names


def test_fastq_blocks_in_columns_equal_rows(tmp_path, monkeypatch):
    """Plain records are taken a column at a time, others a line at a time, at every way to cut the file; and few tasks read a file however small the split is."""
    from germlight.sinks.bam import END, _block
    from germlight.sources import fastq, files

    odd = {40: "\n@odd\r\nAC\r\n+\r\n@I\r\n", 90: "\n\n"}
    text = "".join(odd.get(i, "") + f"@r{i} \u00e9\n{'ACGT' * (i % 40)}\n+\n{'@I+#' * (i % 40)}\n" for i in range(160)).encode()
    expected = list(fastq.records(__import__("io").BytesIO(text), "x"))
    path = str(tmp_path / "a.fastq.gz")
    with open(path, "wb") as f:
        f.write(b"".join(_block(text[at : at + 700]) for at in range(0, len(text), 700)) + END)

    def got(split, **_):
        reader = fastq.FastqReader(path, split)
        return [row for span in reader.partitions() for batch in reader.read(span) for row in zip(*(c.to_pylist() for c in batch.columns))]

    for at_once in (1 << 20, 900):
        monkeypatch.setattr(fastq._columns, "__defaults__", (at_once,))
        for split in (37, 150, 400, 1000, 1 << 20):
            assert got(split) == expected
    monkeypatch.setattr(files, "MOST", 3)
    assert len(fastq.FastqReader(path, 37).partitions()) == 3 and got(37) == expected
    calls = []
    monkeypatch.setattr(fastq, "records", lambda *a: calls.append(a) or iter(()))
    plain = text.split(b"\n@odd")[0]
    with open(path, "wb") as f:
        f.write(b"".join(_block(plain[at : at + 700]) for at in range(0, len(plain), 700)) + END)
    assert len(got(1 << 20)) == 40 and calls  # all whole records without the reader of lines


def test_bam_records_in_columns_equal_rows():
    import random

    from germlight.sinks import bam

    random.seed(3)
    some = lambda n, letters: "".join(random.choices(letters, k=n))
    rows = []
    for i in range(500):
        n = random.choice([0, 1, 2, 7, 40])
        rows.append((random.choice([None, "", f"r{i}", f"\u00fc{i}"]), random.choice([0, 4, 256, 2048]), random.choice([None, "chr1", "chr2", "zz"]), random.choice([None, 0, 5, 70_000, 1 << 20]), random.choice([None, 0, 60]), random.choice([None, "", "40M", "10M100N10M"]), random.choice([None, some(n, "ACGTNacgR\u00e9=")]), random.choice([None, "", some(n, "!IJ#~")]), random.choice([None, "", "AC-1"]), random.choice([None, "GG"])))
    import pyarrow as pa

    kinds = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), *[pa.string()] * 5]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=list(bam.FIELDS))
    number = {"chr1": 0, "chr2": 1}
    one = lambda name, flag, ref, start, mapq, cigar, seq, qual, cb, ub: bam.encoded(name, flag, number.get(ref, -1), -1 if start is None else start, mapq or 0, cigar, seq, qual, {"CB": cb, "UB": ub})
    assert bam.records_of(batch, number, ("CB", "UB")) == b"".join(one(*r) for r in rows)
    assert bam.records_of(batch.slice(100, 50), number, ("CB", "UB")) == b"".join(one(*r) for r in rows[100:150])


def test_bam_batches_equal_single_records(tmp_path):
    """Columns decoded together equal the records decoded one by one, with tags of all kinds, repeated and missing ones, dashes, odd lengths, and however the file is cut."""
    import random
    import struct

    from germlight.sinks import bam as sink
    from germlight.sources.bam import _CORE, BamReader

    random.seed(5)
    out = bytearray(sink.header([("chr1", 1 << 29), ("chr2", 1 << 29)], "unsorted"))
    some = lambda n, letters: "".join(random.choices(letters, k=n))
    for i in range(700):
        n = random.choice([0, 1, 2, 7, 40])
        own = sink.encoded(random.choice(["", f"r{i}"]), random.choice([0, 4, 16, 256, 2048]), random.choice([-1, 0, 1]), random.choice([-1, 0, 5, 70_000]), random.choice([0, 20, 60]), random.choice([None, "40M", "10M100N10M", "5S3=2X1D"]), some(n, "ACGTN"), random.choice([None, some(n, "!IJ#~")]), {})
        for _ in range(random.choice([0, 1, 2, 3, 5])):
            k = random.choice([b"CB", b"UB", b"NM"])
            own += random.choice([k + b"Z" + some(random.randint(0, 9), "ACGT-1").encode() + b"\0"] * 6 + [k + b"i" + struct.pack("<i", 7), k + b"Ax", k + b"C\5", k + b"f" + struct.pack("<f", 1.5), k + b"BI" + struct.pack("<i2I", 2, 160, 17), b"CGBI" + struct.pack("<i2I", 2, 160, 17)])
        out += struct.pack("<i", len(own) - 4) + own[4:]
    path = str(tmp_path / "odd.bam")
    with open(path, "wb") as f:
        f.write(b"".join(sink._block(bytes(out[at : at + 9000])) for at in range(0, len(out), 9000)) + sink.END)
    for options in ({}, {"split": "5000"}, {"split": "3000", "sequence": "false"}, {"barcode_tag": "NM", "umi_tag": "CB"}):
        reader = BamReader({"path": path, **options})
        got = [row for span in reader.partitions() for batch in reader.read(span) for row in zip(*(c.to_pylist() for c in batch.columns))]
        alone = []
        for span in reader.partitions():
            for chunk in reader.chunks(span, 1):
                for a, b, first in zip(chunk.starts.tolist(), chunk.ends.tolist(), chunk.first.tolist()):
                    data = chunk.data[a:b]
                    ref, pos, name, mapq, _, steps, flag, bases, _, _, _ = _CORE.unpack_from(data)
                    alone.append(reader._row(data, first, chunk.references, ref, pos, name, mapq, steps, flag, bases))
        assert len(got) == 700 and got == alone


def test_bam_is_read_by_few_tasks(tmp_path, monkeypatch):
    """However small the split is, the driver plans no more spans than MOST for files of that size."""
    from germlight.sinks import bam as sink
    from germlight.sources import files
    from germlight.sources.bam import BamReader

    path = str(tmp_path / "a.bam")
    out = sink.header([("chr1", 1000)], "unsorted") + b"".join(sink.encoded(f"r{i}", 0, 0, i, 9, "4M", "ACGT", None, {}) for i in range(900))
    with open(path, "wb") as f:
        f.write(b"".join(sink._block(out[at : at + 2000]) for at in range(0, len(out), 2000)) + sink.END)
    monkeypatch.setattr(files, "MOST", 5)
    reader = BamReader({"path": path, "split": "50"})
    assert len(reader.partitions()) <= 5
    assert [x for span in reader.partitions() for b in reader.read(span) for x in b.column(0).to_pylist()] == [f"r{i}" for i in range(900)]


def test_sam_lines_are_split_once(spark):
    """However many fields and filters use the split, the plan holds it once."""
    from germlight.sources import sam

    lines = spark.createDataFrame([("r\t0\tchr1\t5\t60\t4M\t*\t0\t0\tACGT\t*\tNM:i:2 ",), ("@HD\tVN:1.6",), (None,)], "value string")
    found = sam.parse_sam(lines).select("read_id", "mismatches", "mapq", "flag", "reference_start")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("regexp_replace(") == 1
    assert [tuple(r) for r in found.collect()] == [("r", 2, 60, 0, 4)]


def test_blocks_are_deflated_at_a_fast_level():
    """Whole, and as level 3 makes them: level 5 took twice the time of encoding the records."""
    import gzip
    import zlib

    data = b"".join(b"read_%d\tACGTN%d\n" % (i, i * i % 997) for i in range(2500))
    deflate = zlib.compressobj(3, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    other = zlib.compressobj(5, zlib.DEFLATED, -15)
    assert body != other.compress(data) + other.flush()
    assert gzip.decompress(_block(data)) == data and _block(data)[18:-8] == body
