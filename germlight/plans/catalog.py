"""Driver queries: each operator over the driver's tables, with the SQL that its rows must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from germlight.functions import scalar
from germlight.functions.storage import delete, materialised, passing_folder, step_by_step
from germlight.operators import chain, contamination, genomes, host, kmer, lca, matrix, minimizers, qc, quantify, reads as read_ops, taxonomy, umi
from germlight.operators.dedup import last_wins
from germlight import pipeline
from germlight.options import Options
from germlight.plans.proxy import COUNTS_SQL, ORDINAL, READS_SQL, as_reads, counts, reads, spread, table
from germlight.sinks.bam import write_bam
from germlight.sinks.matrix import write_mtx, write_tsv
from germlight.sinks.text import write_fasta, write_fastq, write_fastq_blocks
from germlight.sources import assembly, bai, barcodes, fasta, kraken, register, sam

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Thresholds of the queries, those of the defaults where the tables' values allow.
MAPQ, IDENTITY, MIN_MAPQ, AMBIENT, SPECIFICITY, MIN_CELLS, MAX_MICROBES = 30, 95.0, 1, 0.1, 2.0, 100, 35


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def with_reads(sql: str) -> str:
    return f"WITH {READS_SQL} {sql}"


def with_counts(sql: str) -> str:
    return f"WITH {COUNTS_SQL} {sql}"


# Scans, filters, tags

_CANDIDATE = "NOT is_secondary AND NOT is_supplementary AND (is_unmapped OR (NOT is_unmapped AND mapq < 30))"


@query(with_reads(f"SELECT read_id, ordinal_part, mapq, is_unmapped FROM reads WHERE {_CANDIDATE}"))
def candidate_reads(spark, sf_dir):
    return read_ops.candidate_reads(reads(spark, sf_dir, cells=False, species=False), MAPQ).select("read_id", "ordinal_part", "mapq", "is_unmapped")


_PRIMARY = "NOT is_secondary AND NOT is_supplementary"


@query(
    with_reads(
        f"""SELECT count(*) AS total_reads, count(*) FILTER ({_PRIMARY} AND NOT is_unmapped) AS mapped_reads, count(*) FILTER ({_PRIMARY} AND is_unmapped) AS unmapped_reads,
  count(*) FILTER ({_PRIMARY} AND NOT is_unmapped AND mapq < 30) AS low_mapq_reads, count(*) FILTER ({_PRIMARY} AND coalesce(tagged_barcode, '') <> '') AS reads_with_barcode,
  count(*) FILTER ({_PRIMARY} AND coalesce(tagged_umi, '') <> '') AS reads_with_umi, count(*) FILTER ({_CANDIDATE}) AS candidate_reads FROM reads"""
    )
)
def parse_stats(spark, sf_dir):
    own = reads(spark, sf_dir, species=False).drop("barcode", "umi").withColumnsRenamed({"tagged_barcode": "barcode", "tagged_umi": "umi"})
    return read_ops.parse_stats(own, MAPQ)


@query("SELECT c_custkey, split_part(replace(c_name, '#', '-'), '-', 1) AS barcode, replace(c_name, '#', '-') AS umi FROM customer")
def barcode_umi_tags(spark, sf_dir):
    tag = F.translate("c_name", "#", "-")
    return table(spark, sf_dir, "customer").select("c_custkey", scalar.barcode_of(tag).alias("barcode"), tag.alias("umi"))


@query(with_reads("SELECT DISTINCT tagged_barcode AS barcode FROM reads WHERE coalesce(tagged_barcode, '') <> ''"))
def unique_barcodes(spark, sf_dir):
    return read_ops.unique_barcodes(reads(spark, sf_dir, species=False).select(F.col("tagged_barcode").alias("barcode")))


@query(with_reads("SELECT read_id, ordinal_part, barcode FROM reads WHERE EXISTS (SELECT 1 FROM customer WHERE c_mktsegment = 'BUILDING' AND CAST(c_custkey AS VARCHAR) = barcode)"))
def barcode_semi_join(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.concat(F.col("c_custkey").cast("string"), F.lit("-1")).alias("barcode"))
    return read_ops.reads_by_barcode(reads(spark, sf_dir, species=False).select("read_id", "ordinal_part", "barcode"), wanted)


@query(with_reads("SELECT read_id, ordinal_part, mapq FROM reads WHERE is_unmapped OR mapq < 30"))
def host_primary(spark, sf_dir):
    return host.host_primary(reads(spark, sf_dir, cells=False, species=False), MAPQ).select("read_id", "ordinal_part", "mapq")


_HITS = "hits AS (SELECT *, (length - mismatches) / length * 100 AS identity FROM reads WHERE NOT is_unmapped)"


def _hits(spark, sf_dir) -> DataFrame:
    of = scalar.identity(F.col("length"), F.col("mismatches"))
    return reads(spark, sf_dir, cells=False, species=False).where(~F.col("is_unmapped")).select("read_id", *ORDINAL, "mismatches", of.alias("identity"), (of >= IDENTITY).alias("is_host"))


@query(with_reads(f", {_HITS} SELECT read_id, ordinal_part, ordinal_price, identity, identity >= 95.0 AS is_host FROM hits"))
def host_identity(spark, sf_dir):
    return _hits(spark, sf_dir).select("read_id", "ordinal_part", "ordinal_price", "identity", "is_host")


_LAST = "row_number() OVER (PARTITION BY read_id ORDER BY ordinal_part DESC, ordinal_supp DESC, ordinal_price DESC) = 1"


@query(with_reads(f", {_HITS} SELECT read_id, ordinal_part, mapq FROM reads WHERE NOT EXISTS (SELECT 1 FROM (SELECT read_id, identity FROM hits QUALIFY {_LAST}) h WHERE h.read_id = reads.read_id AND identity >= 95.0)"))
def host_anti_join(spark, sf_dir):
    return host.without_host(reads(spark, sf_dir, cells=False, species=False).select("read_id", "ordinal_part", "mapq"), _hits(spark, sf_dir), order=ORDINAL)


@query(with_reads("SELECT read_id, ordinal_part, mapq FROM reads WHERE NOT EXISTS (SELECT 1 FROM reads h WHERE h.read_id = reads.read_id AND NOT h.is_unmapped)"))
def host_any_hit(spark, sf_dir):
    return host.without_host(reads(spark, sf_dir, cells=False, species=False).select("read_id", "ordinal_part", "mapq"), _hits(spark, sf_dir), mode="any_hit")


@query(
    with_reads(
        f""", {_HITS}, p AS (SELECT * FROM reads WHERE is_unmapped OR mapq < 30), s AS (SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM (SELECT read_id, identity FROM hits QUALIFY {_LAST}) h WHERE h.read_id = p.read_id AND identity >= 95.0))
SELECT (SELECT count(*) FROM reads) - (SELECT count(*) FROM p) AS primary_filtered, (SELECT count(*) FROM p) - (SELECT count(*) FROM s) AS secondary_filtered, (SELECT count(*) FROM s) AS passed"""
    )
)
def host_stats(spark, sf_dir):
    hits = _hits(spark, sf_dir).select("read_id", F.struct(*ORDINAL).alias("ordinal"), "is_host")
    return host.host_stats(reads(spark, sf_dir, cells=False, species=False).select("read_id", "mapq", "is_unmapped"), hits, MAPQ)


@query(with_reads(f"SELECT read_id, ordinal_part, ordinal_supp, ordinal_price, species, mapq FROM reads QUALIFY {_LAST}"))
def last_wins_dedup(spark, sf_dir):
    return last_wins(reads(spark, sf_dir, cells=False).select("read_id", *ORDINAL, "species", "mapq"), "read_id", ORDINAL)


# Taxonomy


def _assignments(spark, sf_dir) -> DataFrame:
    aligned = reads(spark, sf_dir, cells=False).where(F.col("microbe_mapq") >= MIN_MAPQ)
    return aligned.select("read_id", F.struct(*ORDINAL).alias("ordinal"), "species", scalar.confidence(F.col("microbe_mapq")).alias("confidence"), "classified")


_ASSIGNED = f"""last AS (SELECT read_id, barcode, umi FROM reads QUALIFY {_LAST}),
aligned AS (SELECT read_id, species, least(microbe_mapq / 60.0, 1.0) AS confidence, classified FROM reads WHERE microbe_mapq >= 1 QUALIFY {_LAST}),
assigned AS (SELECT read_id, barcode, umi, species, confidence, classified FROM last JOIN aligned USING (read_id))"""


def _assigned(spark, sf_dir) -> DataFrame:
    own = reads(spark, sf_dir, species=False).select("read_id", F.struct(*ORDINAL).alias("ordinal"), "barcode", "umi")
    return taxonomy.assign(own, _assignments(spark, sf_dir)).drop("ordinal")


@query(with_reads(f", {_ASSIGNED} SELECT read_id, barcode, umi, species, round(CAST(confidence AS DOUBLE), 9) AS confidence, classified FROM assigned"))
def taxonomy_join(spark, sf_dir):
    return _assigned(spark, sf_dir).select("read_id", "barcode", "umi", "species", F.round("confidence", 9).alias("confidence"), "classified")


@query(with_reads(f", {_ASSIGNED} SELECT count(*) AS total_reads, count(*) FILTER (classified) AS classified_reads, count(*) FILTER (NOT classified) AS unclassified_reads, count(DISTINCT species) FILTER (classified) AS unique_species FROM assigned"))
def aligner_stats(spark, sf_dir):
    return taxonomy.aligner_stats(_assigned(spark, sf_dir))


@query(
    """SELECT concat(l_orderkey, '_', l_linenumber) AS read_id, 100 - 2 * l_linenumber AS length, CAST(round(l_discount * 100) AS INT) AS mismatches, CAST(l_quantity AS INT) AS mapq,
  l_linenumber AS flag, concat('ref', l_suppkey) AS reference_name, CAST(l_partkey - 1 AS INT) AS reference_start FROM lineitem WHERE l_linenumber & 4 = 0"""
)
def sam_parse(spark, sf_dir):
    n = 100 - 2 * F.col("l_linenumber")
    fields = [
        F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")), F.col("l_linenumber").cast("string"), F.concat(F.lit("ref"), F.col("l_suppkey").cast("string")),
        F.col("l_partkey").cast("string"), F.col("l_quantity").cast("int").cast("string"), F.lit("100M"), F.lit("*"), F.lit("0"), F.lit("0"), F.repeat(F.lit("A"), n), F.lit("*"), F.lit("AS:i:7"),
        F.concat(F.lit("NM:i:"), F.round(F.col("l_discount") * 100).cast("int").cast("string")),
    ]
    rows = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_discount"))
    lines = rows.select(F.concat_ws("\t", *fields).alias("value"))
    lines = lines.unionByName(spark.createDataFrame([("@HD\tVN:1.6",), ("short\tline",)], "value string"))
    return sam.parse_sam(lines).select("read_id", F.length("sequence").alias("length"), "mismatches", "mapq", "flag", "reference_name", "reference_start")


@query(
    """SELECT concat('c', c_custkey) AS read_id, CAST(c_nationkey AS VARCHAR) AS taxid, CASE WHEN c_acctbal > 0 THEN c_name ELSE 'unclassified' END AS species,
  CASE WHEN c_acctbal > 0 THEN n_name ELSE 'unclassified' END AS genus, CASE WHEN c_acctbal > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence, 100 AS alignment_length, c_acctbal > 0 AS classified
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def kraken_parse(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    state = F.when(F.col("c_acctbal") > 0, "C").otherwise("U")
    lines = rows.select(F.concat_ws("\t", state, F.concat(F.lit("c"), F.col("c_custkey").cast("string")), F.col("c_nationkey").cast("string"), F.lit("100"), F.concat_ws(";", "r_name", "n_name", "c_name")).alias("value"))
    return kraken.parse_kraken(lines).select("read_id", "taxid", "species", "genus", "confidence", "alignment_length", "classified")


@query("SELECT p_partkey, CASE WHEN len(string_split(p_name, ' ')) >= 2 THEN array_to_string(string_split(p_name, ' ')[1:2], ' ') ELSE p_name END AS species, p_brand AS whole FROM part")
def species_from_ref(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", scalar.species_of(F.col("p_name")).alias("species"), scalar.species_of(F.col("p_brand")).alias("whole"))


# Quantification


@query(
    with_reads(
        """, v AS (SELECT *, coalesce(tagged_barcode, '') <> '' AS b, coalesce(tagged_umi, '') <> '' AS u FROM reads)
SELECT count(*) AS total_reads, count(*) FILTER (classified AND b AND u) AS valid_reads, count(*) FILTER (classified AND NOT b) AS without_barcode, count(*) FILTER (classified AND b AND NOT u) AS without_umi,
  count(DISTINCT (species, tagged_barcode)) FILTER (classified AND b AND u) AS pairs, count(*) FILTER (classified AND b AND u) AS total_umis,
  count(DISTINCT (species, tagged_barcode, tagged_umi)) FILTER (classified AND b AND u) AS deduplicated_umis FROM v"""
    )
)
def quant_valid_stats(spark, sf_dir):
    own = reads(spark, sf_dir).drop("barcode", "umi").withColumnsRenamed({"tagged_barcode": "barcode", "tagged_umi": "umi"})
    return quantify.quantification_stats(own)


@query(with_counts("SELECT * FROM counts"))
def quant_umi(spark, sf_dir):
    return counts(spark, sf_dir, kept=False)


@query(with_reads("SELECT species, barcode, count(*) AS n FROM reads WHERE classified GROUP BY species, barcode"))
def quant_reads(spark, sf_dir):
    return quantify.quantified(reads(spark, sf_dir), "reads")


_PAD = "rpad({0}, CAST(greatest(length(a), length(b)) AS INT), 'N')"


@query(f"SELECT c_custkey, CAST(hamming({_PAD.format('a')}, {_PAD.format('b')}) AS INT) AS distance FROM (SELECT c_custkey, c_name AS a, c_mktsegment AS b FROM customer)")
def umi_hamming_distance(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", scalar.hamming(F.col("c_name"), F.col("c_mktsegment")).alias("distance"))


@query(
    """WITH e AS (SELECT event_type AS species, CAST(user_id AS VARCHAR) AS barcode, lpad(CAST(json_extract(props, '$.k') AS VARCHAR), 4, '0') AS umi, min(event_id) AS o FROM events GROUP BY ALL),
l AS (SELECT species, barcode, list(umi ORDER BY o) AS u FROM e WHERE umi IS NOT NULL GROUP BY ALL)
SELECT species, barcode, CAST(len(list_reduce(u, lambda a, x: CASE WHEN len(list_filter(a, lambda k: hamming(k, x[1]) <= 1)) > 0 THEN a ELSE list_append(a, x[1]) END, []::VARCHAR[])) AS BIGINT) AS n
FROM (SELECT species, barcode, list_transform(u, lambda y: [y]) AS u FROM l)"""
)
def umi_hamming_dedup(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    own = events.select(F.col("event_type").alias("species"), F.col("user_id").cast("string").alias("barcode"), F.lpad(F.get_json_object("props", "$.k"), 4, "0").alias("umi"), F.col("event_id").alias("ordinal"))
    found = umi.hamming_clusters(own.where(scalar.present(F.col("umi"))))
    return found.select("species", "barcode", F.size("umis").cast("long").alias("n"))


# Matrix, contamination, quality

_DIMS = "sd AS (SELECT species, row_number() OVER (ORDER BY species) AS m FROM (SELECT DISTINCT species FROM counts)), cd AS (SELECT barcode, row_number() OVER (ORDER BY barcode) AS c FROM (SELECT DISTINCT barcode FROM counts))"


@query(with_counts(f", {_DIMS} SELECT CAST(c AS INT) AS cell, CAST(m AS INT) AS microbe, n FROM counts JOIN sd USING (species) JOIN cd USING (barcode)"))
def matrix_coo(spark, sf_dir):
    own = counts(spark, sf_dir)
    return matrix.coo(own, quantify.species_dim(own), quantify.cell_dim(own))


@query(with_counts(f", {_DIMS} SELECT species, list(coalesce(n, 0)::BIGINT ORDER BY c) AS n FROM sd CROSS JOIN cd LEFT JOIN (SELECT species, barcode, sum(n) AS n FROM counts GROUP BY ALL) USING (species, barcode) GROUP BY species"))
def matrix_dense_rows(spark, sf_dir):
    own = counts(spark, sf_dir)
    return matrix.dense_rows(own, quantify.cell_dim(own))


SCORES_SQL = _SCORES = """size AS (SELECT count(DISTINCT barcode) AS cells FROM counts),
ambient AS (SELECT species, count(*) AS nz, CAST(sum(n) AS BIGINT) AS total, max(n) AS max_count FROM counts GROUP BY species),
ranked AS (SELECT species, n, row_number() OVER (PARTITION BY species ORDER BY n) AS k, count(*) OVER (PARTITION BY species) AS c FROM counts),
sums AS (SELECT species, sum(n)::DOUBLE AS t, sum(n * n)::DOUBLE AS q, sum(n * (c - k + 1))::DOUBLE AS s FROM ranked GROUP BY species),
spec AS (SELECT species, t / cells AS mean, sqrt(greatest(q / cells - (t / cells) * (t / cells), 0)) AS std, (cells + 1 - 2 * s / t) / cells AS gini FROM sums, size),
masks AS (SELECT species, NOT (nz / cells > 0.1 AND total / nz < 2 AND max_count < 5) AS ka, nz >= 100 AS kp, std / mean * (1 + gini) >= 2.0 AS ks FROM ambient JOIN spec USING (species), size)"""
_AMBIENT_COLUMNS = "species, nz, total, round(total / nz, 9) AS mean_positive, round(nz / cells, 9) AS fraction, max_count"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query(with_counts(f", {_SCORES} SELECT {_AMBIENT_COLUMNS} FROM ambient, size"))
def ambient_scores(spark, sf_dir):
    return _rounded(contamination.ambient_scores(counts(spark, sf_dir)), "mean_positive", "fraction")


@query(with_counts(f", {_SCORES} SELECT species FROM masks WHERE ka"))
def ambient_filter(spark, sf_dir):
    return contamination.ambient_scores(counts(spark, sf_dir)).where(~contamination.is_ambient(AMBIENT)).select("species")


@query(with_counts(f", {_SCORES} SELECT species, nz FROM ambient WHERE nz >= 100"))
def prevalence_filter(spark, sf_dir):
    return contamination.ambient_scores(counts(spark, sf_dir)).where(F.col("nz") >= MIN_CELLS).select("species", "nz")


@query(with_counts(f", {_SCORES} SELECT species, round(mean, 6) AS mean, round(std, 6) AS std, round(std / mean, 6) AS cv, round(gini, 6) AS gini, round(std / mean * (1 + gini), 6) AS specificity FROM spec"))
def specificity_scores(spark, sf_dir):
    scored = contamination.specificity_scores(counts(spark, sf_dir))
    return scored.select("species", *(F.round(c, 6).alias(c) for c in ("mean", "std", "cv", "gini", "specificity")))


@query(with_counts(f", {_SCORES} SELECT species FROM masks WHERE ks"))
def specificity_filter(spark, sf_dir):
    return contamination.specificity_scores(counts(spark, sf_dir)).where(F.col("specificity") >= SPECIFICITY).select("species")


def _masks(own: DataFrame, method: str = "ambient") -> DataFrame:
    return contamination.species_masks(own, method, AMBIENT, min_cells=MIN_CELLS, specificity_threshold=SPECIFICITY)


@query(with_counts(f", {_SCORES} SELECT species, barcode, n FROM counts WHERE species IN (SELECT species FROM masks WHERE ka AND ks)"))
def contamination_filter(spark, sf_dir):
    own = counts(spark, sf_dir)
    return contamination.decontaminated(own, _masks(own)).select("species", "barcode", "n")


@query(with_counts(f", {_SCORES} SELECT count(*) AS input_species, count(*) FILTER (NOT ka) AS filtered_ambient, count(*) FILTER (NOT kp) AS filtered_low_prevalence, count(*) FILTER (NOT ks) AS filtered_low_specificity, count(*) FILTER (ka AND kp AND ks) AS retained FROM masks"))
def contamination_stats(spark, sf_dir):
    return contamination.contamination_stats(_masks(counts(spark, sf_dir), "both"))


_PROFILE = """totals AS (SELECT barcode, sum(n) AS total FROM counts GROUP BY barcode),
empties AS (SELECT barcode FROM totals WHERE total <= (SELECT quantile_cont(total, 0.1) FROM totals)),
own AS (SELECT species, sum(n) AS ambient FROM counts JOIN empties USING (barcode) GROUP BY species),
profile AS (SELECT species, coalesce(ambient, 0) / (SELECT sum(ambient) FROM own) AS ambient_frac FROM (SELECT DISTINCT species FROM counts) LEFT JOIN own USING (species))"""


@query(with_counts(f", {_PROFILE} SELECT species, round(ambient_frac, 9) AS ambient_frac FROM profile"))
def ambient_profile(spark, sf_dir):
    return _rounded(contamination.ambient_profile(counts(spark, sf_dir)), "ambient_frac")


@query(with_counts(f", {_PROFILE} SELECT species, barcode, round(CAST(CAST(greatest(0.0, n - total * ambient_frac) AS FLOAT) AS DOUBLE), 4) AS n FROM counts JOIN totals USING (barcode) JOIN profile USING (species)"))
def ambient_correct(spark, sf_dir):
    own = counts(spark, sf_dir)
    return contamination.ambient_corrected(own, contamination.ambient_profile(own)).withColumn("n", F.round(F.col("n").cast("double"), 4))


@query(with_counts("SELECT barcode, count(*) FILTER (n > 0) AS n_microbes FROM counts GROUP BY barcode HAVING count(*) FILTER (n > 0) > 35"))
def doublets(spark, sf_dir):
    return contamination.doublets(counts(spark, sf_dir, kept=False), MAX_MICROBES)


@query(with_counts("SELECT barcode, CAST(sum(n) AS BIGINT) AS total FROM counts GROUP BY barcode"))
def cell_totals(spark, sf_dir):
    return matrix.cell_totals(counts(spark, sf_dir, kept=False))


@query(
    with_counts(
        """, v AS (SELECT 'microbes_per_cell' AS metric, count(*) AS v FROM counts GROUP BY barcode UNION ALL SELECT 'reads_per_cell', sum(n) FROM counts GROUP BY barcode
  UNION ALL SELECT 'cells_per_microbe', count(*) FROM counts GROUP BY species UNION ALL SELECT 'reads_per_microbe', sum(n) FROM counts GROUP BY species)
SELECT metric, round(avg(v), 6) AS mean, CAST(median(v) AS DOUBLE) AS median, CAST(max(v) AS DOUBLE) AS max, CAST(min(v) AS DOUBLE) AS min FROM v GROUP BY metric"""
    )
)
def qc_summary(spark, sf_dir):
    own = counts(spark, sf_dir)
    dims = own.select("species").distinct(), own.select("barcode").distinct()
    return qc.qc_summary(own, *dims).withColumn("mean", F.round("mean", 6))


@query(with_counts(", s AS (SELECT count(DISTINCT species) AS n_species, count(DISTINCT barcode) AS n_cells, CAST(sum(n) AS BIGINT) AS total, count(*) AS nnz FROM counts) SELECT *, round(1 - nnz / (n_species * n_cells), 9) AS sparsity FROM s"))
def matrix_summary(spark, sf_dir):
    own = counts(spark, sf_dir)
    return _rounded(qc.matrix_summary(own, own.select("species").distinct(), own.select("barcode").distinct()), "sparsity")


# FASTQ, FASTA, genomes


def _text_records(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return rows.select(F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("name"), F.col("text").alias("sequence"), F.repeat(F.lit("I"), F.length("text")).alias("quality"))


_TEXT = "t AS (SELECT concat(conv_id, '_', turn) AS name, text AS sequence, repeat('I', length(text)) AS quality FROM conversations)"


@query(f"WITH {_TEXT} SELECT name, length(sequence) AS length FROM t WHERE length(sequence) BETWEEN 50 AND 400")
def fastq_length_filter(spark, sf_dir):
    return read_ops.length_filtered(_text_records(spark, sf_dir), 50, 400).select("name", F.length("sequence").cast("long").alias("length"))


@query(f"WITH {_TEXT} SELECT concat('@', name, chr(10), coalesce(sequence, ''), chr(10), '+', chr(10), coalesce(quality, '')) AS record FROM t")
def to_fastq(spark, sf_dir):
    return _text_records(spark, sf_dir).select(scalar.fastq_text(F.col("name"), F.col("sequence"), F.col("quality")).alias("record"))


@query(f"WITH {_TEXT} SELECT concat('>', name, chr(10), coalesce(sequence, '')) AS record FROM t")
def to_fasta(spark, sf_dir):
    return _text_records(spark, sf_dir).select(scalar.fasta_text(F.col("name"), F.col("sequence")).alias("record"))


@query("SELECT count(*) AS records FROM conversations")
def fastq_count(spark, sf_dir):
    """Records of compressed FASTQ files, as the reader finds them."""
    folder = _folder(spark, "fastq")
    write_fastq(_text_records(spark, sf_dir).withColumn("sequence", F.regexp_replace(F.coalesce("sequence", F.lit("")), r"\s", "N")).withColumn("quality", F.regexp_replace("sequence", ".", "I")), folder, compress=True, name="name")
    register(spark)
    return spark.read.format("fastq").load(folder).agg(F.count("*").alias("records"))


_SUMMARY = "SELECT 'https://genomes/' || {key} AS url, CAST({key} AS VARCHAR) AS accession FROM {table} WHERE {where}"


@query(
    f"""SELECT url, accession FROM (SELECT *, row_number() OVER (ORDER BY r, url) AS k FROM (SELECT 0 AS r, * FROM ({_SUMMARY.format(key='c_custkey', table='customer', where="c_mktsegment = 'BUILDING' AND c_acctbal > 0")})
UNION ALL SELECT 1, * FROM ({_SUMMARY.format(key='s_suppkey', table='supplier', where='s_acctbal > 0')}))) WHERE k <= 1000"""
)
def genome_list(spark, sf_dir):
    level = lambda condition: F.when(condition, genomes.LEVEL).otherwise("Scaffold")
    status = lambda condition: F.when(condition, genomes.STATUS).otherwise("replaced")
    url = lambda key: F.concat(F.lit("https://genomes/"), F.col(key).cast("string"))
    first = table(spark, sf_dir, "customer").select(status(F.col("c_acctbal") > 0).alias("version_status"), level(F.col("c_mktsegment") == "BUILDING").alias("assembly_level"), url("c_custkey").alias("ftp_path"))
    second = table(spark, sf_dir, "supplier").select(status(F.col("s_acctbal") > 0).alias("version_status"), level(F.lit(True)).alias("assembly_level"), url("s_suppkey").alias("ftp_path"))
    return genomes.genome_list(first, second, limit=assembly.MAX_GENOMES)


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity / 50 * 100 >= 95)")
def contig_anti_join(spark, sf_dir):
    paf = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("query_name"), F.col("l_quantity").alias("matches"), F.lit(50).alias("alignment_length"))
    return genomes.without_contigs(table(spark, sf_dir, "part").select("p_partkey", "p_name"), genomes.host_like_contigs(paf), "p_partkey")


@query(with_reads("SELECT species AS reference_name, ordinal_part AS reference_start, read_id FROM reads"))
def coordinate_sort(spark, sf_dir):
    own = reads(spark, sf_dir, cells=False).select(F.col("species").alias("reference_name"), F.col("ordinal_part").alias("reference_start"), "read_id")
    return read_ops.coordinate_sorted(own)


# Files written and read back: the parsers over whole tables


def _folder(spark: SparkSession, label: str) -> str:
    return passing_folder(spark, label)


def _bam(spark, sf_dir, barcodes_: DataFrame | None = None, **options) -> DataFrame:
    """The reads as BAM in the shared folder, read by the data source."""
    own = reads(spark, sf_dir, species=False)
    flag = sum((F.col(c).cast("int") * bit for c, bit in (("is_unmapped", 4), ("is_secondary", 256), ("is_supplementary", 2048))), F.lit(0))
    barcode = F.when(F.col("tagged_barcode") != "", F.concat("tagged_barcode", F.lit("-1"))).otherwise(F.col("tagged_barcode"))
    place = F.when(~F.col("is_unmapped"), F.col("ordinal_part").cast("int"))
    rows = own.select(
        "read_id", flag.alias("flag"), F.when(~F.col("is_unmapped"), F.lit("chr2")).alias("reference_name"), place.alias("reference_start"), "mapq", F.when(~F.col("is_unmapped"), F.lit("40M")).alias("cigar"),
        F.repeat(F.lit("ACGTN"), 8).alias("sequence"), F.repeat(F.lit("IIII#"), 8).alias("quality"), barcode.alias("barcode"), F.col("tagged_umi").alias("umi"),
    )
    folder = _folder(spark, "bam")
    write_bam(rows, folder, [("chr1", 1000), ("chr2", 1 << 29)])
    register(spark)
    if barcodes_ is not None:
        return barcodes.read_bam_of(spark, folder, barcodes_, **options)
    return spark.read.format("bam").options(**options).load(folder)


_BAM_COLUMNS = """read_id, mapq, CAST(is_unmapped::INT * 4 + is_secondary::INT * 256 + is_supplementary::INT * 2048 AS INT) AS flag, is_unmapped, is_secondary, is_supplementary, tagged_barcode AS barcode, tagged_umi AS umi,
  CASE WHEN NOT is_unmapped THEN 'chr2' END AS reference_name, CASE WHEN NOT is_unmapped THEN CAST(ordinal_part AS INT) END AS reference_start, CASE WHEN NOT is_unmapped THEN '40M' END AS cigar"""
_BAM_READ = ("read_id", "mapq", "flag", "is_unmapped", "is_secondary", "is_supplementary", "barcode", "umi", "reference_name", "reference_start", "cigar")


@query(with_reads(f"SELECT {_BAM_COLUMNS}, repeat('ACGTN', 8) AS sequence, repeat('IIII#', 8) AS quality FROM reads"))
def bam_scan(spark, sf_dir):
    return _bam(spark, sf_dir, split="400000").select(*_BAM_READ, "sequence", "quality")


@query(with_reads(f"SELECT {_BAM_COLUMNS} FROM reads WHERE {_CANDIDATE}"))
def bam_candidates(spark, sf_dir):
    return _bam(spark, sf_dir, candidates="true", sequence="false", mapq=str(MAPQ)).select(*_BAM_READ)


@query(with_reads(f"SELECT {_BAM_COLUMNS}, repeat('ACGTN', 8) AS sequence FROM reads WHERE EXISTS (SELECT 1 FROM customer WHERE c_mktsegment = 'BUILDING' AND CAST(c_custkey AS VARCHAR) = tagged_barcode)"))
def bam_barcodes(spark, sf_dir):
    """Records of other cells are dropped inside the scan."""
    wanted = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.concat(F.col("c_custkey").cast("string"), F.lit("-1")).alias("barcode"))
    return _bam(spark, sf_dir, wanted, split="400000").select(*_BAM_READ, "sequence")


@query(
    with_reads(
        f"""SELECT tagged_barcode AS barcode, count(*) AS n_reads, count(DISTINCT tagged_umi) AS n_umis FROM reads
  WHERE {_CANDIDATE} AND coalesce(tagged_barcode, '') <> '' AND coalesce(tagged_umi, '') <> '' GROUP BY tagged_barcode"""
    )
)
def bam_to_counts(spark, sf_dir):
    own = _bam(spark, sf_dir, candidates="true", sequence="false", mapq=str(MAPQ)).select("barcode", "umi", "mapq", "is_unmapped", "is_secondary", "is_supplementary")
    valid = read_ops.candidate_reads(own, MAPQ).withColumns({"species": F.lit("any"), "classified": F.lit(True)})
    return quantify.quantified_both(valid).select("barcode", "n_reads", "n_umis")


# Sorted, indexed BAM: line items are reads of three references, some with a gap, and the seventh of an order is unmapped


_PLACED_SQL = """placed AS (SELECT concat(l_orderkey, '_', l_linenumber) AS read_id, l_linenumber = 7 AS unmapped, CASE WHEN l_linenumber <> 7 THEN concat('chr', l_suppkey % 3 + 1) END AS reference_name,
  CASE WHEN l_linenumber <> 7 THEN CAST(50 * l_partkey + l_linenumber AS INT) END AS reference_start, CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_quantity AS INT) + 110 ELSE CAST(l_quantity AS INT) END AS bases FROM lineitem)"""


def _indexed_bam(spark, sf_dir) -> str:
    """The folder of a sorted BAM with indexes."""
    text, line = (lambda c: F.col(c).cast("string")), F.col("l_linenumber")
    n, mapped = F.col("l_quantity").cast("int"), line != 7
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("_", text("l_orderkey"), text("l_linenumber")).alias("read_id"), F.when(mapped, 0).otherwise(4).alias("flag"), F.when(mapped, F.concat(F.lit("chr"), (F.col("l_suppkey") % 3 + 1).cast("int").cast("string"))).alias("reference_name"),
        F.when(mapped, (50 * F.col("l_partkey") + line).cast("int")).alias("reference_start"), F.lit(60).alias("mapq"), F.when(mapped, F.concat(n.cast("string"), F.when(line % 3 == 0, F.lit("M100N10M")).otherwise(F.lit("M")))).alias("cigar"),
        F.repeat(F.lit("A"), F.when(line % 3 == 0, n + 10).otherwise(n)).alias("sequence"), F.lit(None).cast("string").alias("quality"), F.lit(None).cast("string").alias("barcode"), F.lit(None).cast("string").alias("umi"),
    )
    folder = _folder(spark, "indexed")
    write_bam(rows, folder, [(f"chr{i}", 1 << 29) for i in (1, 2, 3)], coordinate_sorted=True)
    bai.write_index(spark, folder, split=400_000)
    return folder


@query(f"WITH {_PLACED_SQL} SELECT read_id, reference_name, reference_start FROM placed WHERE reference_name = 'chr2' AND reference_start < 60000 AND reference_start + bases > 20000")
def bam_region(spark, sf_dir):
    """Of the indexed files only the blocks of the region are read."""
    folder = _indexed_bam(spark, sf_dir)
    return spark.read.format("bam").options(region="chr2:20001-60000", sequence="false", split="200000").load(folder).select("read_id", "reference_name", "reference_start")


@query(f"WITH {_PLACED_SQL} SELECT CAST(count_if(NOT unmapped) AS BIGINT) AS mapped, CAST(count_if(unmapped) AS BIGINT) AS unmapped FROM placed")
def bam_index_totals(spark, sf_dir):
    """From the indexes alone."""
    return bai.index_totals(spark, _indexed_bam(spark, sf_dir)).agg(F.sum("mapped").alias("mapped"), F.sum("unmapped").alias("unmapped"))


@query(f"WITH {_PLACED_SQL} SELECT read_id, reference_name, reference_start, row_number() OVER (ORDER BY reference_name NULLS LAST, reference_start NULLS FIRST, read_id) AS place FROM placed")
def bam_sorted_places(spark, sf_dir):
    """Each record's number in the order of the written files: their indexes say how many they hold, and inside they are numbered by their own places."""
    folder = _indexed_bam(spark, sf_dir)
    own = spark.read.format("bam").options(sequence="false", file="true", split="400000").load(folder)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    sizes = bai.index_totals(spark, folder).select("file", (F.col("mapped") + F.col("unmapped")).alias("_n")).select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("file").orderBy("ordinal")) + F.col("_before")
    return own.join(sizes, "file").select("read_id", "reference_name", "reference_start", place.alias("place"))


@query(
    with_counts(
        """, s AS (SELECT species, row_number() OVER (ORDER BY species) AS i FROM (SELECT DISTINCT species FROM counts)), c AS (SELECT barcode, row_number() OVER (ORDER BY barcode) AS i FROM (SELECT DISTINCT barcode FROM counts))
SELECT '%%MatrixMarket matrix coordinate integer general' AS line UNION ALL SELECT '%' UNION ALL SELECT concat_ws(' ', (SELECT count(*) FROM c), (SELECT count(*) FROM s), (SELECT count(*) FROM counts WHERE n <> 0))
UNION ALL SELECT concat_ws(' ', c.i, s.i, n) FROM counts JOIN s USING (species) JOIN c USING (barcode) WHERE n <> 0"""
    )
)
def matrix_market_lines(spark, sf_dir):
    """The written matrix file, read as text."""
    folder = _folder(spark, "market")
    write_mtx(counts(spark, sf_dir), folder)
    return spark.read.text(f"{folder}/matrix.mtx").withColumnRenamed("value", "line")


@query(
    with_counts(
        """, c AS (SELECT DISTINCT barcode FROM counts), s AS (SELECT DISTINCT species FROM counts), full_ AS (SELECT s.species, c.barcode, coalesce(n, 0) AS n FROM s CROSS JOIN c LEFT JOIN counts USING (species, barcode))
SELECT concat(chr(9), string_agg(barcode, chr(9) ORDER BY barcode)) AS line FROM c UNION ALL SELECT concat(species, chr(9), string_agg(CAST(n AS BIGINT)::VARCHAR, chr(9) ORDER BY barcode)) FROM full_ GROUP BY species"""
    )
)
def matrix_tsv_lines(spark, sf_dir):
    """The written dense file, read as text."""
    folder = _folder(spark, "dense")
    write_tsv(counts(spark, sf_dir), f"{folder}/matrix.tsv")
    return spark.read.text(f"{folder}/matrix.tsv").withColumnRenamed("value", "line")


_LINE_READS = "SELECT concat(l_orderkey, '_', l_linenumber) AS name, repeat('ACGT', CAST(l_quantity AS INT)) AS sequence, repeat('I@#+', CAST(l_quantity AS INT)) AS quality FROM lineitem"


def _line_reads(spark, sf_dir) -> DataFrame:
    """A read for each line item; texts are made after the rows are dealt out."""
    n = F.col("l_quantity").cast("int")
    return spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")).select(F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("name"), F.repeat(F.lit("ACGT"), n).alias("sequence"), F.repeat(F.lit("I@#+"), n).alias("quality"))


@query(f"{_LINE_READS} WHERE 4 * CAST(l_quantity AS INT) BETWEEN 50 AND 150")
def fastq_scan(spark, sf_dir):
    folder = _folder(spark, "fastq")
    write_fastq(_line_reads(spark, sf_dir), folder, compress=True, name="name")
    register(spark)
    return read_ops.length_filtered(spark.read.format("fastq").load(folder), 50, 150).select("name", "sequence", "quality")


@query(_LINE_READS)
def fastq_blocks(spark, sf_dir):
    """Files of gzip blocks, each read by several tasks."""
    folder = _folder(spark, "blocks")
    write_fastq_blocks(_line_reads(spark, sf_dir), folder, name="name")
    register(spark)
    return spark.read.format("fastq").option("split", "20000").load(folder).select("name", "sequence", "quality")


@query("SELECT concat('s', p_partkey) AS name, concat('s', p_partkey, ' a>b ', p_brand) AS header, repeat('ACGTN', p_size) AS sequence FROM part")
def fasta_scan(spark, sf_dir):
    own = table(spark, sf_dir, "part").select(F.concat(F.lit("s"), F.col("p_partkey").cast("string"), F.lit(" a>b "), "p_brand").alias("header"), F.repeat(F.lit("acgtN\n"), F.col("p_size")).alias("sequence"))
    folder = _folder(spark, "fasta")
    write_fasta(own, folder, name="header")
    return fasta.read_fasta(spark, folder).select("name", "header", "sequence")


@query(
    """SELECT concat('c', l_partkey) AS query_name, 100 AS query_length, 0 AS query_start, 50 AS query_end, CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '+' END AS strand, concat('h', l_suppkey) AS target_name, 1000 AS target_length,
  l_linenumber AS target_start, l_linenumber + 50 AS target_end, CAST(l_quantity AS INT) AS matches, 50 AS alignment_length, 60 AS mapq FROM lineitem"""
)
def paf_scan(spark, sf_dir):
    text = lambda c: F.col(c).cast("string")
    line = F.col("l_linenumber")
    fields = [
        F.concat(F.lit("c"), text("l_partkey")), F.lit("100"), F.lit("0"), F.lit("50"), F.when(line % 2 == 0, "-").otherwise("+"), F.concat(F.lit("h"), text("l_suppkey")), F.lit("1000"), text("l_linenumber"), (line + 50).cast("string"),
        F.col("l_quantity").cast("int").cast("string"), F.lit("50"), F.lit("60"), F.lit("tp:A:P"),
    ]
    folder = _folder(spark, "paf")
    table(spark, sf_dir, "lineitem").select(F.concat_ws("\t", *fields)).write.text(folder)
    return assembly.read_paf(spark, folder)


_GENOME = "translate(" + " || ".join(f"md5(concat(c_custkey, '-{i}'))" for i in range(8)) + ", '0123456789abcdef', 'ACGTACGTACGTACGT')"


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS read_id, concat('g', c_custkey) AS reference_name, CAST(c_custkey % 100 AS INT) AS reference_start, c_custkey % 2 = 1 AS reverse, CAST(c_custkey % 3 AS INT) AS mismatches, 60 AS mapq FROM customer"""
)
def kmer_align(spark, sf_dir):
    """Reads of 100 bases, some from the other strand and with up to two bases replaced, against genomes that no two customers share."""
    keys = table(spark, sf_dir, "customer").select("c_custkey")
    genomes_ = spread(keys).select("c_custkey", F.expr(_GENOME).alias("sequence"))
    # A key that the table has twice is two reads of one genome.
    refs = spread(keys.distinct()).select(F.concat(F.lit("g"), F.col("c_custkey").cast("string")).alias("reference"), F.expr(_GENOME).alias("sequence"))
    read = F.expr("substring(sequence, CAST(c_custkey % 100 AS INT) + 1, 100)")
    read = F.when(F.col("c_custkey") % 3 > 0, F.overlay(read, F.lit("N"), F.lit(50))).otherwise(read)
    read = F.when(F.col("c_custkey") % 3 > 1, F.overlay(read, F.lit("N"), F.lit(52))).otherwise(read)
    read = F.when(F.col("c_custkey") % 2 == 1, kmer.complement(read)).otherwise(read)
    own = genomes_.select(F.col("c_custkey").cast("string").alias("read_id"), F.col("c_custkey").alias("ordinal"), read.alias("sequence"))
    return kmer.align(own, refs).select("read_id", "reference_name", "reference_start", "reverse", "mismatches", "mapq")


# Native k-mer assignment: benchmark passages are references, documents are reads.

_K = 24


@query(
    f"""WITH r AS (SELECT DISTINCT item_id, substr(text, i, {_K}) AS kmer FROM (SELECT item_id, text, unnest(range(1, length(text) - {_K} + 2)) AS i FROM benchmark)),
q AS (SELECT DISTINCT doc_id, substr(text, i, {_K}) AS kmer FROM (SELECT doc_id, text, unnest(range(1, length(text) - {_K} + 2)) AS i FROM documents)),
v AS (SELECT doc_id, item_id, count(*) AS votes FROM q JOIN r USING (kmer) GROUP BY ALL)
SELECT doc_id, item_id, votes FROM v QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY votes DESC, item_id) = 1"""
)
def kmer_vote(spark, sf_dir):
    refs = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("reference"), F.col("text").alias("sequence"))
    own = spread(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("read_id"), F.col("text").alias("sequence")))
    best = kmer.vote(own, refs, _K)
    return best.select(F.col("read_id").alias("doc_id"), F.col("reference").alias("item_id"), "votes")


# Classification by lowest common ancestors: items are species, four of them a genus, four genera a family, and documents are reads.


def lca_sql(k: int, w: int, share: float) -> str:
    return f"""WITH src AS (SELECT true AS ref, item_id AS id, text FROM benchmark UNION ALL SELECT false, doc_id, text FROM documents),
km AS (SELECT ref, id, i, length(text) AS len, substr(text, i, {k}) AS v FROM (SELECT *, unnest(range(1, length(text) - {k} + 2)) AS i FROM src)),
mins AS (SELECT ref, id, i, len, min(v) OVER (PARTITION BY ref, id ORDER BY i ROWS BETWEEN CURRENT ROW AND {w - 1} FOLLOWING) AS v FROM km),
m AS (SELECT DISTINCT ref, id, v FROM mins WHERE i <= greatest(len - {k + w - 2}, 1)),
tax AS (SELECT DISTINCT unnest([p[1:1], p[1:2], p[1:3], p]) AS path FROM (SELECT [1, 10 + item_id // 16, 1000 + item_id // 4, 100000 + item_id] AS p FROM benchmark)),
db AS (SELECT v, CASE WHEN count(DISTINCT id) = 1 THEN 100000 + min(id) WHEN count(DISTINCT id // 4) = 1 THEN 1000 + min(id // 4) WHEN count(DISTINCT id // 16) = 1 THEN 10 + min(id // 16) ELSE 1 END AS taxid FROM m WHERE ref GROUP BY v),
hits AS (SELECT m.id, path[-1] AS taxid, path, count(*) AS n FROM m JOIN db USING (v) JOIN tax ON path[-1] = db.taxid WHERE NOT ref GROUP BY ALL),
totals AS (SELECT id, count(*) AS n_minimizers, count(taxid) AS n_hits FROM m LEFT JOIN db USING (v) WHERE NOT ref GROUP BY id),
scores AS (SELECT a.id, a.path, sum(b.n) AS score FROM hits a JOIN hits b ON a.id = b.id AND list_contains(a.path, b.taxid) GROUP BY ALL),
tied AS (SELECT id, path, score FROM scores QUALIFY score = max(score) OVER (PARTITION BY id)),
best AS (SELECT id, max(score) AS score, CASE WHEN count(DISTINCT path[4]) = 1 AND count(path[4]) = count(*) THEN 4 WHEN count(DISTINCT path[3]) = 1 AND count(path[3]) = count(*) THEN 3 WHEN count(DISTINCT path[2]) = 1 AND count(path[2]) = count(*) THEN 2 ELSE 1 END AS depth, min(path) AS path FROM tied GROUP BY id),
clades AS (SELECT id, node, sum(n) AS support FROM (SELECT id, n, unnest(path) AS node FROM hits) GROUP BY ALL),
way AS (SELECT b.id, b.score, c.node, c.support, list_position(b.path, c.node) AS depth FROM best b JOIN clades c ON b.id = c.id AND list_contains(b.path[1:b.depth], c.node) JOIN totals t ON t.id = b.id WHERE c.support >= {share} * n_minimizers),
held AS (SELECT id, max(score) AS score, arg_max(node, depth) AS taxid, arg_max(support, depth) AS support FROM way GROUP BY id)
SELECT doc_id, CAST(taxid AS BIGINT) AS taxid, CAST(coalesce(n_minimizers, 0) AS BIGINT) AS n_minimizers, CAST(coalesce(n_hits, 0) AS BIGINT) AS n_hits, CAST(coalesce(score, 0) AS BIGINT) AS score, CAST(coalesce(support, 0) AS BIGINT) AS support
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN totals t ON d.doc_id = t.id LEFT JOIN held h ON d.doc_id = h.id"""


def item_taxonomy(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(taxid, parent) of the tree above items(item_id), and items with their taxid."""
    own = items.withColumn("item_id", F.col("item_id").cast("long"))
    level = [F.lit(1).cast("long"), *((F.floor(F.col("item_id") / n) + first).cast("long") for first, n in ((10, 16), (1000, 4), (100_000, 1)))]
    nodes = own.select(F.explode(F.array(*(F.struct(t.alias("taxid"), p.alias("parent")) for t, p in zip(level, level[:1] + level[:-1])))).alias("x")).select("x.*").distinct()
    return nodes, own.withColumn("taxid", level[-1])


_LCA = {"k": 10, "w": 5, "share": 0.02}


@query(lca_sql(**_LCA))
def lca_classify(spark, sf_dir):
    nodes, items = item_taxonomy(table(spark, sf_dir, "benchmark"))
    paths, choice = lca.root_paths(nodes), {"k": _LCA["k"], "w": _LCA["w"], "key": minimizers.alphabetic}
    known = lca.database(items.select("taxid", F.col("text").alias("sequence")), paths, **choice)
    own = spread(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("sequence")))
    return lca.classify(own, known, paths, "doc_id", confidence=_LCA["share"], **choice)


# Gapped alignment: reads with planted indels, replaced bases, repeats and both strands


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS read_id, concat('g', c_custkey) AS reference_name, CAST(c_custkey % 100 AS BIGINT) AS reference_start, c_custkey % 2 = 1 AS reverse,
  CAST([0, 3, 2, 2][c_custkey % 4 + 1] AS INT) AS mismatches, CASE WHEN c_custkey % 4 = 2 THEN 2 ELSE 0 END AS inserted, CASE WHEN c_custkey % 4 = 1 THEN 3 ELSE 0 END AS deleted, c_custkey % 5 <> 0 AS placed_once FROM customer"""
)
def chain_align(spark, sf_dir):
    """Every fifth genome is there twice; reads lose three bases, gain two, have two replaced, or are whole."""
    genomes_ = spread(table(spark, sf_dir, "customer").select("c_custkey")).select("c_custkey", F.expr(_GENOME).alias("sequence"))
    key = F.col("c_custkey")
    name = lambda letter: F.concat(F.lit(letter), key.cast("string"))
    refs = genomes_.select(F.explode(F.when(key % 5 == 0, F.array(name("g"), name("h"))).otherwise(F.array(name("g")))).alias("reference"), "sequence")
    read = F.expr("substring(sequence, CAST(c_custkey % 100 AS INT) + 1, 100)")
    head, tail = F.substring(read, 1, 50), lambda at: F.substring(read, at, 100)
    read = F.when(key % 4 == 1, F.concat(head, tail(54))).when(key % 4 == 2, F.concat(head, F.lit("GT"), tail(51))).when(key % 4 == 3, F.overlay(F.overlay(read, F.lit("N"), F.lit(48)), F.lit("N"), F.lit(55))).otherwise(read)
    read = F.when(key % 2 == 1, kmer.complement(read)).otherwise(read)
    own = genomes_.select(key.cast("string").alias("read_id"), key.cast("long").alias("ordinal"), read.alias("sequence"))
    found = chain.align(own, chain.build_index(refs))
    bases = lambda op: F.aggregate(F.regexp_extract_all("cigar", F.lit(rf"(\d+){op}")), F.lit(0), lambda a, n: a + n.cast("int"))
    return found.select("read_id", "reference_name", "reference_start", "reverse", "mismatches", bases("I").alias("inserted"), bases("D").alias("deleted"), (F.col("mapq") >= 30).alias("placed_once"))


# From a BAM file to counts, through host removal and taxonomy by alignment


_BRAND = "translate(" + " || ".join(f"md5(concat(p_brand, '-{i}'))" for i in range(8)) + ", '0123456789abcdef', 'ACGTACGTACGTACGT')"
_HOST = "translate(" + " || ".join(f"md5(concat(n_name, '-{i}'))" for i in range(8)) + ", '0123456789abcdef', 'ACGTACGTACGTACGT')"


@query(
    f"""WITH {READS_SQL},
counts AS (SELECT p_brand AS species, tagged_barcode AS barcode, count(DISTINCT tagged_umi) AS n FROM reads JOIN part ON ordinal_part = p_partkey
  WHERE {_CANDIDATE} AND coalesce(tagged_barcode, '') <> '' AND coalesce(tagged_umi, '') <> '' AND ordinal_supp % 3 <> 0 GROUP BY ALL), {SCORES_SQL}
SELECT species, barcode, n, ka AND ks AS keep FROM counts JOIN masks USING (species)"""
)
def bam_to_matrix(spark, sf_dir):
    """Reads of suppliers that 3 divides are host, the others are of their part's brand; each has 80 bases, one replaced, of a place that its order names, and every other order's are turned."""
    # Parts meet their reads by shuffle, without the genomes: with them, some hundred MB of parts were broadcast, since the planner counts a computed text as 20 bytes.
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    brands = part.select("p_brand").distinct().select("p_brand", F.expr(_BRAND).alias("_microbe"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), F.expr(_HOST).alias("_host"))
    order = F.col("umi").cast("long")
    lines = table(spark, sf_dir, "lineitem").join(part.hint("merge"), F.col("l_partkey") == F.col("p_partkey"))
    # Both joins shuffle the tables' own columns, not the texts made of them. Orders come last, so that lines of an order lie together, and the joined lines are
    # written, so that no shuffle's files lie beside the BAM.
    lines = as_reads(lines, table(spark, sf_dir, "orders").hint("merge"), more=("p_brand",))
    lines, joined = materialised(lines.select("read_id", "ordinal_part", "ordinal_supp", "umi", "tagged_umi", "tagged_barcode", "mapq", "is_unmapped", "is_secondary", "is_supplementary", "p_brand"), "lines")
    own = lines.join(F.broadcast(brands), "p_brand").join(F.broadcast(nations), F.pmod(order, F.lit(25)) == F.col("n_nationkey"))
    is_host = F.col("ordinal_supp") % 3 == 0
    bases = F.overlay(F.substring(F.when(is_host, F.col("_host")).otherwise(F.col("_microbe")), (order % 170 + 1).cast("int"), F.lit(80)), F.lit("N"), F.lit(41))
    flag = sum((F.col(c).cast("int") * bit for c, bit in (("is_unmapped", 4), ("is_secondary", 256), ("is_supplementary", 2048))), F.lit(0))
    rows = own.select(
        F.concat_ws("_", "read_id", F.col("ordinal_part").cast("string"), F.col("ordinal_supp").cast("string")).alias("read_id"), flag.alias("flag"), F.when(~F.col("is_unmapped"), F.lit("chr2")).alias("reference_name"), F.when(~F.col("is_unmapped"), F.lit(7)).alias("reference_start"), "mapq",
        F.when(~F.col("is_unmapped"), F.lit("80M")).alias("cigar"), F.when(order % 2 == 0, bases).otherwise(kmer.complement(bases)).alias("sequence"), F.repeat(F.lit("I"), 80).alias("quality"), F.col("tagged_barcode").alias("barcode"), F.col("tagged_umi").alias("umi"),
    )
    folder = _folder(spark, "matrix")
    with step_by_step(spark):
        write_bam(rows, f"{folder}/bam", [("chr1", 1000), ("chr2", 1 << 29)])
    delete(spark, joined)
    write_fasta(brands.withColumnRenamed("_microbe", "sequence"), f"{folder}/microbes", name="p_brand")
    write_fasta(table(spark, sf_dir, "nation").select("n_name", F.expr(_HOST).alias("sequence")), f"{folder}/host", name="n_name")
    options = Options(aligner="chain", skip_contamination_filter=True)
    # As pipeline.run does, each step is written as it is made, and deleted once the next one is there: else every use of the reads decodes the files again.
    found = read_ops.candidate_reads(pipeline.read_bam(spark, f"{folder}/bam", options), options.host_mapq, options.include_unmapped, options.include_low_mapq)
    candidates, first = materialised(found.select(*pipeline.columns_used(options)), "candidates")
    delete(spark, f"{folder}/bam")
    clean, second = materialised(pipeline.clean_reads(spark, candidates, options, f"{folder}/host", True), "clean")
    delete(spark, first)
    assigned = pipeline.assigned_reads(spark, clean, options, f"{folder}/microbes", None, True)
    raw, _ = materialised(quantify.quantified(assigned, options.quant_method, options.umi_dedup_method, options.umi_threshold), "counts")
    delete(spark, second)
    masks = contamination.species_masks(raw, "ambient", AMBIENT, specificity_threshold=SPECIFICITY)
    return raw.join(masks.select("species", "keep"), "species").select("species", "barcode", "n", "keep")
