"""Unique molecular identifiers: exact and Hamming-tolerant."""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from germlight.functions.scalar import hamming
from germlight.functions.storage import checkpointed


def exact_umis(umis: Column) -> Column:
    return F.array_distinct(umis)


def hamming_umis(umis: Column, threshold: int = 1) -> Column:
    """Greedy clusters in the given order: a code is kept if it is further than threshold from every one kept before."""
    far = lambda kept, u: ~F.exists(kept, lambda k: hamming(k, u) <= threshold)
    return F.aggregate(umis, F.array().cast("array<string>"), lambda kept, u: F.when(far(kept, u), F.array_append(kept, u)).otherwise(kept))


def deduplicated(umis: Column, method: str = "exact", threshold: int = 1) -> Column:
    if method == "exact":
        return exact_umis(umis)
    if method == "hamming":
        return hamming_umis(umis, threshold)
    raise ValueError(f"unknown deduplication method {method!r}")


#: Codes of a group up to which they are folded in one row; masks of a code up to which codes meet by masks.
FOLD, MASKS = 256, 100


def _meeting_places(code: Column, length: int, threshold: int) -> tuple[Column, bool]:
    """Texts of a code of that length, of which any two codes within threshold of each other share one; and whether all that share one are that near.

    All choices of threshold masked places have both properties; where those are too many, threshold + 1 segments have the first one.
    """
    if math.comb(length, threshold) <= MASKS:
        masks = [sorted(places) for places in combinations(range(1, length + 1), threshold)]
        left = [list(zip([0, *m], [*m, length + 1])) for m in masks]
        return F.array(*(F.concat_ws("*", F.lit(str(i)), *(F.substring(code, a + 1, b - a - 1) for a, b in cut)) for i, cut in enumerate(left))), True
    step = -(-length // (threshold + 1))
    return F.array(*(F.concat(F.lit(f"{i}*"), F.substring(code, i * step + 1, step)) for i in range(threshold + 1))), False


def _decided(live: DataFrame, keys: tuple[str, ...], length: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(codes that are kept for certain, all codes that are decided by that) of live(keys, _umi, _first).

    A code is kept if it comes before all undecided codes near it, and then those are not: the greedy clusters are the first independent set in this order.
    """
    places, exact = _meeting_places(F.rpad("_umi", length, "N"), length, threshold)
    own = live.select(*keys, "_umi", "_first", F.explode(places).alias("_at"))
    mine = F.struct("_first", "_umi")
    if exact:  # those of a place are all near each other: one aggregate for each place, and no pairs
        least = own.groupBy(*keys, "_at").agg(F.min(mine).alias("_least"))
        kept = own.join(least, [*keys, "_at"]).groupBy(*keys, "_umi", "_first").agg(F.bool_and(F.col("_least") == mine).alias("_keep")).where("_keep").drop("_keep")
        taken = kept.select(*keys, F.explode(places).alias("_at"))
        return kept, own.join(taken, [*keys, "_at"], "left_semi").select(*keys, "_umi").distinct()
    other = own.select(*keys, "_at", F.col("_umi").alias("_other"), F.col("_first").alias("_when"))
    pairs = own.join(other, [*keys, "_at"]).where((F.col("_umi") != F.col("_other")) & (hamming(F.col("_umi"), F.col("_other")) <= threshold))
    later = pairs.where(F.struct("_when", "_other") < mine).select(*keys, "_umi").distinct()
    kept = live.join(later, [*keys, "_umi"], "left_anti")
    near = pairs.join(kept.select(*keys, "_umi"), [*keys, "_umi"], "left_semi").select(*keys, F.col("_other").alias("_umi"))
    return kept, kept.select(*keys, "_umi").unionByName(near).distinct()


def hamming_kept(reads: DataFrame, keys: tuple[str, ...] = ("species", "barcode"), threshold: int = 1, order: str = "ordinal", umi: str = "umi", fold: int = FOLD) -> DataFrame:
    """keys, umi and order of first sight of the codes that begin a cluster: those further than threshold from every one kept before.

    Repeats leave before the shuffle (one never adds a cluster). Groups of up to `fold` distinct codes are folded in a row each; larger ones are decided in rounds over all
    their codes, spread by what near codes have in common, until what is undecided of a group is small enough to be folded. What remains then is far from all that is kept, so the
    result is that of the one fold. Codes and keys may not be null.
    """
    first = checkpointed(reads.groupBy(*keys, F.col(umi).alias("_umi")).agg(F.min(order).alias("_first")))
    kept: list[DataFrame] = []
    rest, live = first, first
    while True:
        large = live.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > fold).select(*keys)
        large = checkpointed(large)
        if large.isEmpty():
            break
        small = live.join(large, [*keys], "left_anti")
        rest = small if live is first else rest.unionByName(checkpointed(small))
        live = checkpointed(live.join(large, [*keys], "left_semi"))
        length = live.agg(F.max(F.length("_umi"))).first()[0]
        certain, done = _decided(live, keys, max(length, threshold, 1), threshold)
        kept.append(checkpointed(certain.select(*keys, "_umi", "_first")))
        live = checkpointed(live.join(done, [*keys, "_umi"], "left_anti"))
    if live is not first:
        rest = rest.unionByName(live)
    lists = rest.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_first", "_umi"))).alias("_codes"))
    folded = lists.select(*keys, "_codes", hamming_umis(F.transform("_codes", lambda x: x["_umi"]), threshold).alias("_kept"))
    folded = folded.select(*keys, F.explode(F.filter("_codes", lambda x: F.array_contains("_kept", x["_umi"]))).alias("_x")).select(*keys, "_x._umi", "_x._first")
    return reduce(DataFrame.unionByName, kept, folded).select(*keys, F.col("_umi").alias(umi), F.col("_first").alias(order))


def hamming_clusters(reads: DataFrame, keys: tuple[str, ...] = ("species", "barcode"), threshold: int = 1, order: str = "ordinal", umi: str = "umi", fold: int = FOLD) -> DataFrame:
    """keys and umis: the kept codes in order of first sight, a row a group; hamming_kept has them as rows."""
    kept = hamming_kept(reads, keys, threshold, order, umi, fold)
    return kept.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, umi))).alias("_all")).select(*keys, F.transform("_all", lambda x: x[umi]).alias("umis"))
