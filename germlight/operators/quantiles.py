"""Exact percentiles without all of a group's values in one task: equal values are counted first, and ranks are found over range partitions of the rest.

The sorted runs are written out, since a second sort could draw its ranges elsewhere. A partition gives one short row for each of its groups; their sums tell which
partitions hold the wanted ranks, and only those are numbered value by value.

Defined cases: nulls don't count, NaN is the greatest value, a group without values has no row, ties are one run of their count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from germlight.functions.storage import checkpointed


def value_runs(values: DataFrame, group: str, value: str) -> DataFrame:
    """(group, v, m, _p): each distinct value as a double with its count, sorted, and the number of the partition that holds it."""
    found = values.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("group"), F.col(value).cast("double").alias("v")).agg(F.count("*").alias("m"))
    return checkpointed(found.sort("group", "v").select("group", "v", "m", F.spark_partition_id().alias("_p")))


def percentiles(runs: DataFrame, share: float) -> DataFrame:
    """(group, percentile) of value_runs: interpolated between the two nearest ranks, as SQL's percentile function does."""
    if not 0 <= share <= 1:
        raise ValueError(f"a percentile's share must lie between 0 and 1, not {share}")
    by = Window.partitionBy("group")
    parts = runs.groupBy("group", "_p").agg(F.sum("m").alias("_n"))
    # Ranks from 0: the partition holds those from _before up to, not including, _before + _n.
    parts = parts.select("group", "_p", "_n", (F.sum("_n").over(by.orderBy("_p")) - F.col("_n")).alias("_before"), ((F.sum("_n").over(by) - 1) * F.lit(float(share))).alias("_rank"))
    low, high = F.floor("_rank"), F.ceil("_rank")
    holds = lambda rank, first, n: (first <= rank) & (rank < first + n)
    parts = parts.where(holds(low, F.col("_before"), F.col("_n")) | holds(high, F.col("_before"), F.col("_n")))
    near = runs.join(parts.select("group", "_p", "_before", "_rank"), ["group", "_p"])
    first = F.col("_before") + F.sum("m").over(Window.partitionBy("group", "_p").orderBy("v")) - F.col("m")
    near = near.withColumn("_first", first).groupBy("group").agg(
        F.max("_rank").alias("_rank"),
        F.max(F.when(holds(low, F.col("_first"), F.col("m")), F.col("v"))).alias("_low"),
        F.max(F.when(holds(high, F.col("_first"), F.col("m")), F.col("v"))).alias("_high"),
    )
    between = (high - F.col("_rank")) * F.col("_low") + (F.col("_rank") - low) * F.col("_high")
    return near.select("group", F.when((low == high) | (F.col("_low") == F.col("_high")), F.col("_low")).otherwise(between).alias("percentile"))
