"""Jobs over growing copies of the tables: each run takes what is new, a broken-off run is made good, and running again changes nothing."""

import json
import os
import subprocess
import sys

import pytest
from conftest import ROOT, SF, normal, same_rows
from pyspark.sql import functions as F

from jobs import common, entry, molecule_counts, taxon_profile


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_job_query_equals_sql(spark, duck, name):
    same_rows(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name])


def files(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def expected(spark, rows, name="species"):
    own = molecule_counts.molecules(rows, spark.read.parquet(f"{SF}/orders.parquet"), spark.read.parquet(f"{SF}/part.parquet"), 30)
    return normal(tuple(r) for r in own.distinct().groupBy("species", "barcode").count().collect())


@pytest.fixture
def growing(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/lineitem.parquet")
    parts = [rows.where(F.col("l_orderkey") % 3 == i) for i in range(3)]
    paths = {"reads": f"{tmp_path}/reads", "orders": f"{SF}/orders.parquet", "parts": f"{SF}/part.parquet", "output": f"{tmp_path}/out", "checkpoint": f"{tmp_path}/state"}
    grow = lambda i: parts[i].coalesce(1).write.mode("append").parquet(paths["reads"])
    return rows, grow, paths


def test_counts_follow_growing_input(spark, growing):
    rows, grow, paths = growing
    grow(0)
    grow(0)  # the same rows again: no molecule is new
    first = molecule_counts.run(spark, **paths)
    assert normal(map(tuple, first.select("species", "barcode", "n").collect())) == expected(spark, rows.where("l_orderkey % 3 = 0"))
    grow(1)
    grow(2)
    before = files(f"{paths['output']}/deltas")
    second = molecule_counts.run(spark, **paths)
    assert normal(map(tuple, second.select("species", "barcode", "n").collect())) == expected(spark, rows)
    after = files(f"{paths['output']}/deltas")
    assert before.items() <= after.items() and len(after) > len(before)
    batches = spark.read.parquet(f"{paths['output']}/deltas").groupBy("batch").agg(F.sum("n").alias("n")).orderBy("batch").collect()
    assert [r["batch"] for r in batches] == [0, 1]
    stood = files(paths["output"])
    third = molecule_counts.run(spark, **paths)
    assert files(paths["output"]) == stood and third.count() == second.count()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_a_run_that_breaks_off_is_made_good(spark, growing, monkeypatch):
    rows, grow, paths = growing
    grow(0)
    real, calls = molecule_counts.replacing, []

    def breaking(df, *partitions):
        calls.append(partitions)
        if len(calls) in (1, 3):  # in the stream's first batch, then between deltas and counts
            raise RuntimeError("power cut")
        return real(df, *partitions)

    monkeypatch.setattr(molecule_counts, "replacing", breaking)
    for _ in range(2):
        with pytest.raises(Exception, match="power cut"):
            molecule_counts.run(spark, **paths)
    grow(1)
    grow(2)
    assert normal(map(tuple, molecule_counts.run(spark, **paths).select("species", "barcode", "n").collect())) == expected(spark, rows)


def test_counts_of_no_reads(spark, growing):
    rows, _, paths = growing
    rows.limit(0).write.parquet(paths["reads"])
    assert molecule_counts.run(spark, **paths).collect() == []


def test_profile_runs_again_and_takes_more_sources(spark, tmp_path):
    docs, panel = spark.read.parquet(f"{SF}/documents.parquet"), f"{SF}/benchmark.parquet"
    one, more, out = f"{tmp_path}/one", f"{tmp_path}/more", f"{tmp_path}/out"
    docs.where("source = 'src0'").withColumn("source", F.when(F.col("doc_id") > 0, F.col("source"))).write.parquet(one)
    docs.where("source <> 'src0'").write.parquet(more)
    first = taxon_profile.run(spark, one, panel, out)
    stood = normal(map(tuple, first.collect()))
    assert normal(map(tuple, taxon_profile.run(spark, one, panel, out).collect())) == stood
    both = taxon_profile.run(spark, more, panel, out)
    assert set(stood) <= set(normal(map(tuple, both.collect())))
    assert spark.read.parquet(f"{out}/calls").count() == docs.count()
    assert both.where("taxid = 1 OR taxid IS NULL").agg(F.sum("n_clade")).first()[0] == docs.count()


def test_config(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"mapq": 20}))
    assert common.load_config(spark, str(path), molecule_counts.DEFAULTS) == {**molecule_counts.DEFAULTS, "mapq": 20}
    path.write_text(json.dumps({"mapp": 20}))
    with pytest.raises(ValueError, match="mapp"):
        common.load_config(spark, str(path), molecule_counts.DEFAULTS)
    for module in (molecule_counts, taxon_profile):
        assert common.load_config(spark, os.path.join(ROOT, "jobs", module.__name__.split(".")[1] + ".json"), module.DEFAULTS) == module.DEFAULTS


def test_command_line(tmp_path):
    command = [sys.executable, "-m", "jobs.taxon_profile", "--documents", f"{SF}/documents.parquet", "--panel", f"{SF}/benchmark.parquet", "--output", f"{tmp_path}/out", "--config", "jobs/taxon_profile.json"]
    shared = {"PYSPARK_SUBMIT_ARGS": f"--conf spark.checkpoint.dir=file://{tmp_path}/shared --conf spark.sql.shuffle.partitions=4 --conf spark.ui.enabled=false pyspark-shell"}
    done = subprocess.run(command, cwd=ROOT, env=os.environ | shared, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "wrote a panel" in done.stderr and "rows of the profile" in done.stderr
