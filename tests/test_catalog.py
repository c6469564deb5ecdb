"""Every query of the catalog against its SQL, on the smallest tables."""

import pytest
from conftest import SF, same_rows

from germlight.plans.catalog import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    same_rows(QUERIES[name](spark, SF), duck, SQL[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) <= set(e.queries())


def test_hot_path_is_native(spark):
    for name in ("specificity_scores", "contamination_filter", "host_anti_join", "umi_hamming_dedup", "kmer_vote"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan


def test_scan_is_pruned_and_filtered(spark):
    plan = QUERIES["candidate_reads"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "lineitem" in x)
    assert "l_comment" not in scan and "l_tax" not in scan.split("ReadSchema")[1]
    assert "PushedFilters: [" in scan and "l_linenumber" in scan.split("PushedFilters")[1]


def test_bam_to_matrix_sends_no_parts_through_the_driver(spark, monkeypatch):
    """Parts grow with the tables and meet their reads by shuffle; genomes are broadcast as one row a brand."""
    from germlight.plans import catalog

    class Seen(Exception):
        pass

    def stop(rows, *_):
        raise Seen(rows._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(catalog, "write_bam", stop)
    with pytest.raises(Seen) as e:
        catalog.bam_to_matrix(spark, "/root/testdata/sf0.001")
    joins = [line for line in str(e.value).splitlines() if "BroadcastHashJoin" in line]
    assert joins and not any("p_partkey" in line for line in joins)


def test_bam_sorted_places_reads_the_files_once(spark):
    """The files' numbers of records come from their indexes, not from another scan."""
    plan = QUERIES["bam_sorted_places"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("RelationV2" in line and "read_id" in line for line in plan.splitlines()) == 1 and plan.count("RelationV2") == 1


def test_bam_to_counts_reads_the_files_once(spark):
    """Reads and molecules are counted in one scan."""
    plan = QUERIES["bam_to_counts"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RelationV2") == 1 and "Join" not in plan


def test_bam_to_matrix_keeps_no_step_that_is_used_up(spark):
    """The BAM files and the steps of the reads are gone when the counts are there; the reads were stored without what no later step reads."""
    import os
    from pathlib import Path

    from germlight.functions.storage import shared_folder

    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(os.listdir(folder))
    found = QUERIES["bam_to_matrix"](spark, SF)
    left = [p.relative_to(folder) for p in folder.rglob("*") if p.is_file() and not p.name.startswith(".") and p.relative_to(folder).parts[0] not in before]
    assert left and not [p for p in left if p.suffix == ".bam" or p.parts[0].split("-")[0] in ("lines", "candidates", "clean")]
    assert found.count()


def test_stored_steps_leave_no_shuffle_files(spark):
    import time

    from germlight.functions.storage import delete, freed_shuffles, materialised

    blocks = lambda: {x for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split() if x.endswith(".data")}
    names = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.files.maxPartitionBytes")
    before, settings = blocks(), [spark.conf.get(x) for x in names]
    found, path = materialised(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "step")
    assert sorted(r["count"] for r in found.collect()) == [142] + [143] * 6 and [spark.conf.get(x) for x in names] == settings
    delete(spark, path)
    for _ in range(100):  # executors delete them in the background
        if not blocks() - before:
            break
        time.sleep(0.1)
    assert not blocks() - before
    with pytest.raises(ZeroDivisionError), freed_shuffles(spark):
        raise ZeroDivisionError
    assert [spark.conf.get(x) for x in names] == settings
