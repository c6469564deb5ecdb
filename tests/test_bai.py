"""Indexes of BAM files: bins, files, regions against a filtered scan, totals and refusals."""

import hashlib
import random
import struct

import pytest
from bam_writer import record, write_bam

from germlight import sources
from germlight.sources import bai
from germlight.sources.bam import BamReader, region_of

REFS = [("chr1", 1 << 28), ("empty", 1000), ("chr2", 1 << 20)]


def _records(n, seed=5):
    rng, rows = random.Random(seed), []
    for i in range(n):
        ref = rng.choice([0, 0, 2])
        pos = rng.randrange(1 << 26 if rng.random() < 0.3 else 1 << 18) if ref == 0 else rng.randrange(1 << 19)
        size = rng.randrange(20, 100)
        cigar = [(size, "M")] if rng.random() < 0.8 else [(10, "S"), (size - 10, "M"), (rng.choice([50, 40_000, 3_000_000]), "N"), (5, "M")]
        rows.append({"name": f"r{i}", "ref": ref, "pos": pos, "flag": rng.choice([0, 16, 256, 4]), "cigar": cigar, "sequence": "A" * (size + 5 * (len(cigar) > 1))})
    rows.sort(key=lambda r: (r["ref"], r["pos"]))
    return rows + [{"name": f"u{i}", "ref": -1, "pos": -1, "flag": 4, "sequence": "ACGT"} for i in range(n // 10)]


def _span(r):
    return r["pos"], r["pos"] + sum(n for n, op in r["cigar"] if op in "MDN=X")


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("bai")
    data = {"a": _records(4000), "b": _records(500, 6), "none": []}
    for name, rows in data.items():
        write_bam(str(folder / f"{name}.bam"), REFS, [record(**r) for r in rows], block=3000)
    sources.register(spark)
    assert bai.write_index(spark, str(folder), split=20_000) == 3
    return folder, [r for rows in data.values() for r in rows]


def test_bins_hold_and_meet():
    rng = random.Random(1)
    for _ in range(3000):
        a = rng.randrange(1 << 29)
        b = min(1 << 29, a + rng.choice([1, 100, 1 << 15, 1 << 24]))
        c = rng.randrange(max(0, a - 50_000), min(b + 50_000, (1 << 29) - 1))
        d = c + rng.choice([1, 1000])
        if a < d and c < b:
            assert bai.bin_of(a, b) in bai.bins_over(c, d)
    assert [bai.bin_of(0, 1), bai.bin_of(0, 1 << 14), bai.bin_of(0, (1 << 14) + 1), bai.bin_of((1 << 26) - 1, (1 << 26) + 1), bai.bin_of((1 << 29) - 1, 1 << 29)] == [4681, 4681, 585, 0, 37448]


def test_splits_make_the_same_index(spark, indexed):
    folder, _ = indexed
    before = {p.name: p.read_bytes() for p in folder.glob("*.bai")}
    assert len(before) == 3 and all(bai.decoded(x).encoded() == x for x in before.values())
    bai.write_index(spark, str(folder))
    for name, data in before.items():
        again, was = bai.decoded((folder / name).read_bytes()), bai.decoded(data)
        assert [(r.mapped, r.unmapped, r.span, r.linear, set(r.bins)) for r in again.references] == [(r.mapped, r.unmapped, r.span, r.linear, set(r.bins)) for r in was.references]


@pytest.mark.parametrize("region", ["chr1", "chr1:1-20000", "chr1:100000-100050", "chr1:60000000-67108864", "chr2:262144", "chr2:500000-", "empty", "other", "chr1:200000000-200000100"])
@pytest.mark.parametrize("split", [4000, 1 << 23])
def test_region_equals_the_filtered_scan(spark, indexed, region, split):
    folder, rows = indexed
    name, start, end = region_of(region)
    expected = sorted(r["name"] for r in rows if not r["flag"] & 4 and REFS[r["ref"]][0] == name and _span(r)[0] < end and _span(r)[1] > start)
    got = [r["read_id"] for r in spark.read.format("bam").options(region=region, split=split, sequence="false").load(str(folder)).collect()]
    assert sorted(got) == expected


def test_region_reads_few_blocks(indexed):
    folder, _ = indexed
    path = str(folder / "a.bam")
    everything = BamReader({"path": path, "split": 4000}).partitions()
    few = BamReader({"path": path, "split": 4000, "region": "chr2:400000-400100"}).partitions()
    assert 0 < sum(s.end - s.start for s in few) < sum(s.end - s.start for s in everything) / 5
    assert BamReader({"path": path, "region": "empty"}).partitions() == []


def test_filters_name_the_region(spark, indexed):
    folder, rows = indexed
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        got = spark.read.format("bam_places").options(split=4000).load(str(folder)).where("reference_name = 'chr2' AND reference_start >= 1000 AND reference_start < 90000")
        assert sorted(r["read_id"] for r in got.collect()) == sorted(r["name"] for r in rows if r["ref"] == 2 and not r["flag"] & 4 and 1000 <= r["pos"] < 90000)
        assert 0 < got.rdd.getNumPartitions() < spark.read.format("bam_places").options(split=4000).load(str(folder)).rdd.getNumPartitions() / 2
    finally:
        spark.conf.set(key, before)


def test_totals_without_the_file(spark, indexed, tmp_path):
    folder, rows = indexed
    got = {r["file"].rsplit("/", 1)[1]: (r["mapped"], r["unmapped"]) for r in bai.index_totals(spark, str(folder)).collect()}
    assert got["none.bam"] == (0, 0)
    assert tuple(map(sum, zip(*got.values()))) == (sum(not r["flag"] & 4 for r in rows), sum(bool(r["flag"] & 4) for r in rows))
    write_bam(str(tmp_path / "x.bam"), REFS, [])
    assert [tuple(r)[1:] for r in bai.index_totals(spark, str(tmp_path)).collect()] == [(None, None)]


@pytest.mark.parametrize("split", [3000, 1 << 23])
def test_unsorted_files_are_refused(spark, tmp_path, split):
    write_bam(str(tmp_path / "x.bam"), REFS, [record(**r) for r in reversed(_records(500)[:500])], block=1000)
    sources.register(spark)
    with pytest.raises(Exception, match="sorted"):
        bai.write_index(spark, str(tmp_path), split=split)


def test_long_cigars_stand_in_a_tag(spark, tmp_path):
    steps = [(1, "M"), (1, "I")] * 40_000
    rows = [record("long", ref=0, pos=7, cigar=[(80_000, "S"), (40_000, "N")], sequence="A" * 80_000, tags={"CG": ("B", ("I", [n << 4 | "MIDNSHP=X".index(op) for n, op in steps]))})]
    write_bam(str(tmp_path / "x.bam"), REFS, rows, block=60_000)
    sources.register(spark)
    assert spark.read.format("bam").load(str(tmp_path)).first()["cigar"] == "1M1I" * 40_000


@pytest.mark.parametrize("split", [1 << 30, 9000])
def test_index_parts_are_made_from_columns(tmp_path, monkeypatch, split):
    """The rows that each span is reduced to, against one record after another; none of the own code's steps goes record by record."""
    from germlight.sources import bam

    rows = _records(3000, 8)
    path = str(tmp_path / "x.bam")
    write_bam(path, REFS, [record(**r) for r in rows], block=3000)
    monkeypatch.setattr(bam.PartsReader, "chunks", lambda self, span: BamReader.chunks(self, span, 40_000))
    reader, bin_of = bam.PartsReader({"path": path, "split": str(split)}, bai.PARTS), bai.bin_of
    monkeypatch.setattr(bai, "bin_of", lambda *_: pytest.fail("one record alone"))
    done = 0
    for span in reader.partitions():
        got = list(reader.rows(span))
        chunks, linear, totals, keys = {}, {}, {}, []
        places = [x for chunk in reader.chunks(span) for x in zip(chunk.first.tolist(), chunk.last.tolist())]
        for (first, last), r in zip(places, rows[done:]):
            unmapped = r["flag"] == 4
            start, end = (r["pos"], r["pos"] + 1) if unmapped else _span(r)
            keys.append(((r["ref"] if r["ref"] >= 0 else 1 << 30) << 32 | start + 1, first))
            own = totals.setdefault(r["ref"], [first, last, 0, 0])
            own[1], own[2], own[3] = last, own[2] + (not unmapped), own[3] + unmapped
            if r["ref"] >= 0:
                known = chunks.setdefault((r["ref"], bin_of(start, end)), [])
                if known and first >> 16 <= known[-1][1] >> 16:
                    known[-1][1] = last
                else:
                    known.append([first, last])
                for w in range(start >> bai.WINDOW, (end - 1 >> bai.WINDOW) + 1):
                    linear.setdefault((r["ref"], w), first)
        done += len(places)
        want = [(path, bai.CHUNK, ref, number, *x) for (ref, number), own in chunks.items() for x in own] + [(path, bai.LINEAR, ref, w, first, 0) for (ref, w), first in linear.items()]
        want += [x for ref, (first, last, mapped, none) in totals.items() for x in ((path, bai.PLACES, ref, 0, first, last), (path, bai.NUMBERS, ref, 0, mapped, none))]
        want += [(path, bai.ORDER, -1, keys[0][1], keys[0][0], keys[-1][0])] if keys else []
        assert sorted(x for x in got if x[1] is not None) == sorted(want)
    assert done == len(rows)


def test_written_records_have_their_bin(tmp_path):
    from germlight.sinks.bam import encoded

    assert struct.unpack_from("<H", encoded("a", 0, 0, 70_000, 9, "10M", "A" * 10, None, {}), 14)[0] == bai.bin_of(70_000, 70_010)
    assert struct.unpack_from("<H", encoded("a", 4, -1, -1, 9, None, "A", None, {}), 14)[0] == 4680


def test_barcode_lists_drop_records_in_the_scan(spark, tmp_path):
    from germlight.operators.reads import reads_by_barcode
    from germlight.sources import barcodes

    odd = {"XA": ("A", "q"), "XB": ("B", ("S", (1, 2, 3))), "XF": ("f", 1.5), "NM": ("C", 3)}
    own = ["AAAA-1", "CCCC", "", "-x", None, "GGGG-2", "ünï-1", "AAAA"]
    rows = [{"name": f"r{i}", "pos": i, "cigar": [(4, "M")], "sequence": "ACGT", "flag": [0, 256][i % 2], "tags": odd | ({} if b is None else {"CB": b.encode().decode("latin-1") if b.isascii() else b})} for i, b in enumerate(own * 50) if b is None or b.isascii()]
    write_bam(str(tmp_path / "x.bam"), REFS, [record(**r) for r in rows], block=2000)
    sources.register(spark)
    wanted = spark.createDataFrame([("AAAA-7",), ("CCCC",), ("",), (None,), ("ünï",), ("AAAA",)], "barcode string")
    whole = reads_by_barcode(spark.read.format("bam").load(str(tmp_path)), wanted)
    got = barcodes.read_bam_of(spark, str(tmp_path), wanted, split="1500")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect())) and got.count() == 150
    scanned = spark.read.format("bam").option("barcode_slots", barcodes.bitmap(wanted)).load(str(tmp_path))
    assert scanned.count() == 150
    assert spark.read.format("bam").option("barcode_slots", barcodes.bitmap(wanted.limit(0))).load(str(tmp_path)).count() == 0
    found = barcodes.slots(barcodes.bitmap(spark.range(200_000).selectExpr("concat('B', id) AS barcode")))
    assert all(barcodes.maybe(f"B{i}-1".encode(), found) for i in range(0, 200_000, 7))
    assert sum(barcodes.maybe(f"C{i}".encode(), found) for i in range(20_000)) < 800


def test_bases_of_other_cells_are_not_decoded(tmp_path, monkeypatch):
    import base64
    import zlib

    from germlight.sources import bam, barcodes
    from germlight.sources.bam import Span

    rows = [{"name": f"r{i}", "pos": i, "cigar": [(4, "M")], "sequence": "ACGT", "tags": {"CB": f"CELL{i % 10}-1", "UB": f"U{i}"}} for i in range(200)]
    path = str(tmp_path / "x.bam")
    write_bam(path, REFS, [record(**r) for r in rows], block=2000)
    slot = int.from_bytes(hashlib.md5(b"CELL3").digest()[:4]) % barcodes.SLOTS
    bits = bytearray(barcodes.SLOTS // 8)
    bits[slot >> 3] |= 1 << (slot & 7)
    decoded, bases = [], bam._bases
    monkeypatch.setattr(bam, "_bases", lambda *x: decoded.append(len(x[-1])) or bases(*x))
    reader = BamReader({"path": path, "barcode_slots": base64.b64encode(zlib.compress(bytes(bits))).decode()})
    got = [r for b in reader.batches(Span(path, 0, (tmp_path / "x.bam").stat().st_size)) for r in b.select(["read_id", "umi", "sequence", "reference_start", "cigar"]).to_pylist()]
    assert got == [{"read_id": f"r{i}", "umi": f"U{i}", "sequence": "ACGT", "reference_start": i, "cigar": "4M"} for i in range(3, 200, 10)]
    assert sum(decoded) == 20


def test_tag_text_is_what_tags_says():
    from germlight.sources.bam import tag_text, tags

    data = record("a", tags={"XA": ("A", "q"), "CB": "AC-1", "XB": ("B", ("i", (5, -6))), "XF": ("i", -3), "UB": ""})
    at = 4 + 32 + 2
    for name, value in tags(data, at).items():
        if name != "XB":
            assert tag_text(data, at, name.encode()).decode() == value
    assert tag_text(data, at, b"ZZ") == b""
