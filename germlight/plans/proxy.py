"""The read model over the driver's star schema: every operator also runs on those tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from germlight.functions.storage import checkpointed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df dealt out over all cores, in parts of some SMALL bytes of its files. A file of one row group is one task however large it is, so its size says nothing about the number of tasks."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(max(cores, min(size // SMALL, MOST)))


#: Bytes of a part; most parts.
SMALL, MOST = 8 << 20, 4096


#: The columns that order the rows of a read id.
ORDINAL = ("ordinal_part", "ordinal_supp", "ordinal_price")


def reads(spark: SparkSession, sf_dir: str, cells: bool = True, species: bool = True) -> DataFrame:
    """lineitem as reads; ids repeat, and the ORDINAL columns order the rows of an id.

    cells and species say whether orders and part are joined for the barcode and species columns. Every order line has both, so rows stay the same without.
    """
    return as_reads(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders") if cells else None, table(spark, sf_dir, "part") if species else None)


def as_reads(rows: DataFrame, orders: DataFrame | None = None, parts: DataFrame | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """Order lines, of a table or a stream, as reads; orders give cells, parts species. more: columns of rows that stay as they are."""
    if orders is not None:
        rows = rows.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    if parts is not None:
        rows = rows.join(parts.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    line = F.col("l_linenumber")
    columns = {
        "read_id": F.concat(F.col("l_orderkey").cast("string"), F.lit("_"), line.cast("string")),
        "ordinal_part": F.col("l_partkey"),
        "ordinal_supp": F.col("l_suppkey"),
        "ordinal_price": F.col("l_extendedprice"),
        "mapq": F.col("l_quantity").cast("int"),
        "is_unmapped": F.col("l_returnflag") == "N",
        "is_secondary": line == 7,
        "is_supplementary": line == 6,
        "umi": F.col("l_orderkey").cast("string"),
        "tagged_umi": F.when(line == 3, F.lit("")).otherwise(F.col("l_orderkey").cast("string")),
        "mismatches": F.round(F.col("l_discount") * 100).cast("int"),
        "length": F.lit(100),
        "microbe_mapq": F.round(F.col("l_tax") * 100).cast("int"),
        "classified": F.col("l_linestatus") == "F",
    }
    if orders is not None:
        cell = F.col("o_custkey").cast("string")
        columns |= {"barcode": cell, "tagged_barcode": F.when(line == 4, F.lit(None)).when(line == 5, F.lit("")).otherwise(cell)}
    if parts is not None:
        columns |= {"species": F.col("p_name")}
    return rows.select(*(c.alias(k) for k, c in columns.items()), *more)


READS_SQL = """reads AS (SELECT concat(l_orderkey, '_', l_linenumber) AS read_id, l_partkey AS ordinal_part, l_suppkey AS ordinal_supp, l_extendedprice AS ordinal_price,
  CAST(l_quantity AS INT) AS mapq, l_returnflag = 'N' AS is_unmapped, l_linenumber = 7 AS is_secondary, l_linenumber = 6 AS is_supplementary,
  CASE WHEN l_linenumber = 4 THEN NULL WHEN l_linenumber = 5 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS tagged_barcode,
  CASE WHEN l_linenumber = 3 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS tagged_umi,
  CAST(o_custkey AS VARCHAR) AS barcode, CAST(l_orderkey AS VARCHAR) AS umi, p_name AS species, CAST(round(l_discount * 100) AS INT) AS mismatches,
  100 AS length, CAST(round(l_tax * 100) AS INT) AS microbe_mapq, l_linestatus = 'F' AS classified
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

COUNTS_SQL = READS_SQL + """,
counts AS (SELECT species, barcode, count(DISTINCT umi) AS n FROM reads GROUP BY species, barcode)"""


def counts(spark: SparkSession, sf_dir: str, kept: bool = True) -> DataFrame:
    """Molecules by species and cell. kept: for plans that use them more than once, written out after one scan of the reads."""
    from germlight.operators.quantify import quantified

    found = quantified(reads(spark, sf_dir).withColumn("classified", F.lit(True)))
    return checkpointed(found) if kept else found
