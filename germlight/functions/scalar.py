"""Scalar functions as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of the SAM flag.
UNMAPPED, REVERSE, SECONDARY, SUPPLEMENTARY = 0x4, 0x10, 0x100, 0x800


def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def present(value: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(value, F.lit("")) != ""


def barcode_of(tag: Column) -> Column:
    """A cell barcode without the suffix after its first dash."""
    return F.substring_index(tag, "-", 1)


def stripped(text: Column) -> Column:
    """Without white space of any kind at either end; trim() takes off blanks only."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def mismatches_of(tags: Column) -> Column:
    """The NM tag of a joined tag string; 0 without one."""
    return F.coalesce(F.regexp_extract(tags, r"(?:^|\t)NM:i:(\d+)", 1).try_cast("int"), F.lit(0))


def identity(length: Column, mismatches: Column) -> Column:
    """Per cent of a read's bases that match; 0 for an empty read."""
    return F.when(length > 0, (length - mismatches) / length * 100).otherwise(F.lit(0.0))


def confidence(mapq: Column) -> Column:
    return F.least(mapq / F.lit(60.0), F.lit(1.0))


def species_of(reference: Column) -> Column:
    """The first two words of a reference name, or the whole name where there is one word."""
    words = F.split(stripped(reference), r"\s+")
    return F.when(F.size(words) >= 2, F.concat_ws(" ", F.slice(words, 1, 2))).otherwise(reference)


def lineage_rank(lineage: Column, from_end: int) -> Column:
    """The n-th last name of a ;-separated lineage, or `unclassified`."""
    return F.coalesce(F.try_element_at(F.split(lineage, ";"), F.lit(-from_end)), F.lit("unclassified"))


def hamming(a: Column, b: Column) -> Column:
    """Positions at which two codes differ; the shorter one is filled up with N."""
    n = F.greatest(F.length(a), F.length(b))
    differ = lambda i: (F.substring(F.rpad(a, n, "N"), i, F.lit(1)) != F.substring(F.rpad(b, n, "N"), i, F.lit(1))).cast("int")
    return F.when(n == 0, F.lit(0)).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda acc, i: acc + differ(i)))


def fastq_text(name: Column, sequence: Column, quality: Column) -> Column:
    """A FASTQ record without its last line end."""
    return F.concat(F.lit("@"), name, F.lit("\n"), F.coalesce(sequence, F.lit("")), F.lit("\n+\n"), F.coalesce(quality, F.lit("")))


def fasta_text(name: Column, sequence: Column) -> Column:
    return F.concat(F.lit(">"), name, F.lit("\n"), F.coalesce(sequence, F.lit("")))


def basename(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once a row even where body uses it in lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)
