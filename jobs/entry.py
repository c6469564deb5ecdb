"""The jobs as queries: each runs twice into a new folder of spark.checkpoint.dir, and returns the whole output as it stands then."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from germlight.functions.storage import shared_folder
from germlight.plans.catalog import SCORES_SQL, lca_sql
from germlight.plans.proxy import READS_SQL
from jobs import molecule_counts, taxon_profile


def _folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def job1_molecule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, tables = _folder(spark, "molecule_counts"), [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders", "part")]
    for _ in range(2):
        found = molecule_counts.run(spark, *tables, f"{folder}/out", f"{folder}/checkpoint")
    return found


_JOB1 = f"""WITH {READS_SQL},
counts AS (SELECT species, tagged_barcode AS barcode, count(DISTINCT tagged_umi) AS n FROM reads
  WHERE NOT is_secondary AND NOT is_supplementary AND (is_unmapped OR mapq < 30) AND classified AND coalesce(tagged_barcode, '') <> '' AND coalesce(tagged_umi, '') <> '' GROUP BY ALL), {SCORES_SQL}
SELECT species, barcode, n, ka AND ks AS keep FROM counts JOIN masks USING (species)"""


def job2_taxon_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "taxon_profile")
    for _ in range(2):
        found = taxon_profile.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/benchmark.parquet", f"{folder}/out")
    return found


_JOB2 = f"""WITH calls AS ({lca_sql(taxon_profile.DEFAULTS["k"], taxon_profile.DEFAULTS["w"], taxon_profile.DEFAULTS["confidence"])}),
own AS (SELECT coalesce(source, '') AS source, taxid FROM calls JOIN documents USING (doc_id)),
ways AS (SELECT source, taxid, unnest(CASE WHEN taxid IS NULL THEN [NULL] WHEN taxid >= 100000 THEN [1, 10 + (taxid - 100000) // 16, 1000 + (taxid - 100000) // 4, taxid] WHEN taxid >= 1000 THEN [1, 10 + (taxid - 1000) // 4, taxid] WHEN taxid >= 10 THEN [1, taxid] ELSE [1] END) AS node FROM own)
SELECT source, node AS taxid, count(*) FILTER (node IS NOT DISTINCT FROM taxid) AS n_reads, count(*) AS n_clade, round(count(*) / any_value(n), 9) AS share
FROM ways JOIN (SELECT source, count(*) AS n FROM own GROUP BY source) USING (source) GROUP BY source, node"""


def queries() -> dict:
    return {"job1_molecule_counts": job1_molecule_counts, "job2_taxon_profile": job2_taxon_profile}


def oracle_sql() -> dict[str, str]:
    return {"job1_molecule_counts": _JOB1, "job2_taxon_profile": _JOB2}
