"""Exact percentiles over partitions, and single files joined of parts."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from germlight.operators import contamination, matrix, quantify
from germlight.operators.quantiles import percentiles, value_runs
from germlight.sinks import joined, matrix as matrix_sink


@pytest.fixture(scope="module", autouse=True)
def several_partitions(spark):
    """Small tables would be put into one partition, and nothing of what goes on between partitions would be seen."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    yield
    spark.conf.set(setting, before)


@pytest.fixture(scope="module")
def values(spark, several_partitions):
    rng = random.Random(5)
    rows = [("one", 3.5), ("pair", 1.0), ("pair", 2.0), ("nulls", None), ("nan", float("nan")), ("nan", 1.0), ("below", -2.0), ("below", -0.0), ("below", 0.0)]
    rows += [("ties", float(rng.choice((0, 0, 0, 7, 9)))) for _ in range(500)] + [("even", float(i)) for i in range(300)] + [("many", rng.gauss(0, 1e6)) for _ in range(3001)]
    rows += [("hot", float(int(rng.paretovariate(0.7)))) for _ in range(4000)]
    return spark.createDataFrame(rows, "g string, x double").repartition(7).cache()


@pytest.mark.parametrize("share", [0, 0.1, 0.25, 0.5, 0.505, 0.999, 1])
def test_percentiles_equal_the_aggregate(spark, values, share):
    runs = value_runs(values, "g", "x")
    own = {r[0]: r[1] for r in percentiles(runs, share).collect()}
    theirs = {r[0]: r[1] for r in values.groupBy("g").agg(F.percentile("x", share)).collect()}
    assert theirs.pop("nulls") is None and set(own) == set(theirs)
    for group, value in theirs.items():
        assert own[group] == value or (math.isnan(own[group]) and math.isnan(value)), group


def test_percentiles_spread_a_group(spark, values):
    """A group's values lie in several partitions, and no partition but those that hold the rank is numbered."""
    runs = value_runs(values.where("g = 'many'"), "g", "x")
    assert runs.select("_p").distinct().count() > 1
    assert percentiles(runs, 0.5).count() == 1
    assert value_runs(values.limit(0), "g", "x").count() == 0 and percentiles(value_runs(values.limit(0), "g", "x"), 0.5).count() == 0
    with pytest.raises(ValueError, match="between 0 and 1"):
        percentiles(runs, 1.5)


def test_ambient_profile_of_equal_totals(spark):
    """All cells lie at the percentile, so all of them are empties."""
    own = spark.createDataFrame([("a", "x", 2), ("b", "y", 2), ("b", "z", 2)], "species string, barcode string, n long")
    assert {r[0]: round(r[1], 9) for r in contamination.ambient_profile(own).collect()} == {"a": round(1 / 3, 9), "b": round(2 / 3, 9)}


def test_parts_keep_their_order(spark, tmp_path, monkeypatch):
    """In places and as a stream: the same bytes, whatever the pieces' size."""
    rows = spark.range(5000).repartition(9).sort("id")
    expected = "head\n" + "".join(f"line {i} é\n" for i in range(5000)) + "tail"
    with joined.Scratch(spark) as scratch:
        parts = scratch.parts(rows, F.format_string("line %d é", "id"))
        assert len(parts) > 1
        pieces = [b"head\n", *parts, b"tail"]
        for i, (piece, copy) in enumerate(((1 << 20, 1 << 20), (1000, 7))):
            monkeypatch.setattr(joined, "PIECE", piece)
            monkeypatch.setattr(joined, "COPY", copy)
            for place in (str(tmp_path / f"a{i}" / "x.txt"), f"file://{tmp_path}/b{i}/x.txt"):
                assert joined.write_joined(spark, pieces, place) == len(expected.encode())
                assert open(place.removeprefix("file://"), encoding="utf-8").read() == expected
                assert os.listdir(os.path.dirname(place.removeprefix("file://"))) == ["x.txt"]
        streamed = b"".join(x for piece in joined.without_last_byte(pieces) for x in joined._content(piece))
        assert streamed.decode() == expected[:-1]
        folders = list(scratch.folders)
    assert not any(os.path.exists(f.removeprefix("file:")) for f in folders)
    assert joined.write_joined(spark, [], str(tmp_path / "none")) == 0 and (tmp_path / "none").read_bytes() == b""


def test_matrix_files_are_those_of_a_plain_loop(spark, tmp_path):
    rng = random.Random(8)
    names, cells = [f"sp {i}" for i in range(23)], [f"C{i:03}é" for i in range(61)]
    held = {(s, c): rng.randrange(1, 2000) for s in names for c in cells if rng.random() < 0.2}
    own = spark.createDataFrame([(s, c, n) for (s, c), n in held.items()], "species string, barcode string, n long").repartition(5)
    # Dimension tables may hold what the counts have lost.
    all_species = quantify.indexed(spark.createDataFrame([(s,) for s in [*names, "lost"]], "species string"), "species", "species_idx")
    all_cells = quantify.indexed(spark.createDataFrame([(c,) for c in [*cells, "Z"]], "barcode string"), "barcode", "cell_idx")
    matrix_sink.write_matrix(own, str(tmp_path), species=all_species, cells=all_cells)
    s_order, c_order = sorted([*names, "lost"]), sorted([*cells, "Z"])
    entries = sorted((s_order.index(s) + 1, c_order.index(c) + 1, n) for (s, c), n in held.items())
    text = matrix_sink.BANNER + f"62 24 {len(held)}\n" + "".join(f"{c} {s} {n}\n" for s, c, n in entries)
    assert (tmp_path / "mtx/matrix.mtx").read_text() == text
    assert (tmp_path / "mtx/barcodes.tsv").read_text() == "".join(f"{c}\n" for c in c_order)
    assert (tmp_path / "mtx/features.tsv").read_text() == "".join(f"{s}\n" for s in s_order)
    lines = ["\t".join(["", *c_order]), *("\t".join([s, *(str(held.get((s, c), 0)) for c in c_order)]) for s in s_order)]
    assert (tmp_path / "germlight_matrix.tsv").read_text() == "".join(f"{x}\n" for x in lines)
    before = (tmp_path / "mtx/matrix.mtx").read_bytes()
    matrix_sink.write_mtx(own.repartition(2), str(tmp_path / "mtx"), all_species, all_cells)
    assert (tmp_path / "mtx/matrix.mtx").read_bytes() == before


def test_empty_matrix(spark, tmp_path):
    none = spark.createDataFrame([], "species string, barcode string, n long")
    matrix_sink.write_matrix(none, str(tmp_path))
    assert (tmp_path / "mtx/matrix.mtx").read_text() == matrix_sink.BANNER + "0 0 0\n"
    assert (tmp_path / "mtx/barcodes.tsv").read_text() == "" and (tmp_path / "germlight_matrix.tsv").read_text() == "\n"
    assert matrix.coo(none, quantify.species_dim(none), quantify.cell_dim(none)).count() == 0
