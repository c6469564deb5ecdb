"""Barcode lists inside the BAM scan: records of other cells are dropped before their bases are decoded.

The list becomes a bitmap of 2^23 slots (1 MB, however long the list is) by an aggregate, and a record whose barcode's slot is empty goes. Slots are shared, so what
passes is a superset; the semi join on the list itself follows. Up to some 100,000 barcodes one record in a hundred of other cells passes; a list of millions drops
less, but never a record that is wanted.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from germlight.functions.scalar import barcode_of, present

SLOTS, BUCKET = 1 << 23, 1 << 15


def bitmap(barcodes: DataFrame) -> str:
    """The slots of barcodes(barcode), without suffixes after a dash, compressed as text: at most SLOTS / BUCKET rows of 4 KB come to the driver."""
    own = barcodes.select(barcode_of(F.col("barcode")).alias("b")).where(present(F.col("b")))
    slot = F.conv(F.substring(F.md5(F.encode("b", "utf-8")), 1, 8), 16, 10).cast("long") % SLOTS + 1
    rows = own.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    found = bytearray(SLOTS // 8)
    for r in rows:
        at = (r["bucket"] - 1) * BUCKET // 8
        found[at : at + BUCKET // 8] = bytes(r["bits"])
    return base64.b64encode(zlib.compress(bytes(found), 1)).decode()


def slots(text: str) -> bytes:
    return zlib.decompress(base64.b64decode(text))


def maybe(barcode: bytes, found: bytes) -> bool:
    """Whether a barcode's slot is taken; none and the empty one have no slot."""
    barcode = barcode.partition(b"-")[0]
    k = int.from_bytes(hashlib.md5(barcode, usedforsecurity=False).digest()[:4]) % SLOTS
    return bool(barcode) and bool(found[k >> 3] >> (k & 7) & 1)


def read_bam_of(spark: SparkSession, path: str, barcodes: DataFrame, **options: str) -> DataFrame:
    """The reads of a BAM file, secondary ones too, whose barcode is in the list; as reads_by_barcode of the whole scan."""
    from germlight.operators.reads import reads_by_barcode
    from germlight.sources import register

    register(spark)
    return reads_by_barcode(spark.read.format("bam").options(barcode_slots=bitmap(barcodes), **options).load(path), barcodes)
