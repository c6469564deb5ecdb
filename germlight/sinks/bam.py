"""BAM and block-gzip files: one a partition, in a folder. Readers see only files of tasks that succeeded, since those are moved to their place at the end."""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from germlight.functions.storage import freed_shuffles
from germlight.sources.bai import LEVELS, bin_of
from germlight.sources.files import _store

#: Fixed values of the format: base codes, operations, most bytes of data in a block, the bin of a record without a place, and the empty block that ends a file.
BASES, OPERATIONS, BLOCK = "=ACMGRSVTWYHKDBN", "MIDNSHP=X", 0xFF00
UNPLACED = 4680
#: zlib's level: 3 takes two fifths of the time of 5 and makes files an eighth larger.
LEVEL = 3
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: The column of each field; sequence, quality, cigar and the tags may be null.
FIELDS = ("read_id", "flag", "reference_name", "reference_start", "mapq", "cigar", "sequence", "quality", "barcode", "umi")

_CIGAR = re.compile(r"(\d+)([MIDNSHP=X])")
_NIBBLE = bytes(BASES.find(chr(b).upper()) if BASES.find(chr(b).upper()) >= 0 else 15 for b in range(256))
_CODES = np.frombuffer(_NIBBLE, np.uint8)
#: A record's first 36 bytes.
_CORE = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("steps", "<u2"), ("flag", "<u2"), ("bases", "<i4"), ("mate", "<i4"), ("mate_pos", "<i4"), ("length", "<i4")])


def _block(data: bytes) -> bytes:
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def header(references: list[tuple[str, int]], order: str) -> bytes:
    text = "".join([f"@HD\tVN:1.6\tSO:{order}\n", *(f"@SQ\tSN:{name}\tLN:{length}\n" for name, length in references)]).encode()
    names = b"".join(struct.pack("<i", len(name.encode()) + 1) + name.encode() + b"\0" + struct.pack("<i", length) for name, length in references)
    return b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(references)) + names


def encoded(read_id: str, flag: int, reference: int, start: int, mapq: int, cigar: str | None, sequence: str | None, quality: str | None, tags: dict[str, str | None]) -> bytes:
    """One alignment record with its size."""
    name, steps, bases = (read_id or "*").encode() + b"\0", _CIGAR.findall(cigar or ""), (sequence or "").encode()
    codes = bases.translate(_NIBBLE) + b"\0" * (len(bases) % 2)
    packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2]))
    phred = bytes(b - 33 for b in quality.encode()) if quality else b"\xff" * len(bases)
    extra = b"".join(k.encode() + b"Z" + v.encode() + b"\0" for k, v in tags.items() if v is not None)
    steps_ = b"".join(struct.pack("<I", int(n) << 4 | OPERATIONS.index(op)) for n, op in steps)
    bases_on = sum(int(n) for n, op in steps if op in "MDN=X")
    body = struct.pack("<iiBBHHHiiii", reference, start, len(name), mapq, bin_of(start, start + bases_on) if start >= 0 else UNPLACED, len(steps), flag, len(bases), -1, -1, 0) + name + steps_ + packed + phred + extra
    return struct.pack("<i", len(body)) + body


def write_blocks(rows: DataFrame, folder: str, suffix: str, head: bytes, encode: Callable[[pa.RecordBatch], bytes]) -> list[str]:
    """Writes head and then encode(batch) of all rows, in order, as gzip blocks that state their length, a file a partition; returns the files' names, in order."""
    parts = f"_parts-{uuid.uuid4().hex}"
    store, path = _store(folder)
    store.create_dir(f"{path}/{parts}", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        name, data = f"{TaskContext.get().partitionId():06}-{uuid.uuid4().hex}{suffix}", head
        with store.open_output_stream(f"{path}/{parts}/{name}", compression=None) as out:
            for batch in batches:
                data += encode(batch)
                full = len(data) // BLOCK * BLOCK
                for at in range(0, full, BLOCK):
                    out.write(_block(data[at : at + BLOCK]))
                data = data[full:]
            if data:
                out.write(_block(data))
            out.write(END)
        yield pa.RecordBatch.from_pydict({"name": [name]})

    with freed_shuffles(rows.sparkSession):
        names = sorted(r["name"] for r in rows.mapInArrow(write, "name string").collect())  # one short row for each file
    for name in names:
        store.move(f"{path}/{parts}/{name}", f"{path}/{name}")
    store.delete_dir(f"{path}/{parts}")
    return names


def values_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a column of texts or bytes without nulls, one value after another."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def records_of(batch: pa.RecordBatch, number: dict[str, int], tags: tuple[str, str]) -> bytes:
    """encoded() of every row of FIELDS, a column at a time."""
    n = len(batch)
    if not n:
        return b""
    columns = dict(zip(FIELDS, batch.columns))

    def whole(name: str, missing: int, low: int, high: int) -> np.ndarray:
        found = pc.fill_null(columns[name].cast(pa.int64()), missing).to_numpy(zero_copy_only=False)
        if found.min() < low or found.max() > high:
            raise ValueError(f"{name} from {found.min()} to {found.max()} in a BAM record")
        return found

    def each(column: pa.Array, of: Callable[[str | None], object]) -> tuple[np.ndarray, list]:
        """Which of the results, and the results, of a column's different values."""
        coded = column.dictionary_encode(null_encoding="encode")
        return coded.indices.to_numpy(zero_copy_only=False), [of(x) for x in coded.dictionary.to_pylist()]

    text = lambda name: columns[name].cast(pa.large_binary())
    join = lambda *parts: pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.large_binary()))
    one = lambda value: pa.scalar(value, pa.large_binary())
    names = pc.fill_null(text("read_id"), b"")
    names = join(pc.if_else(pc.equal(pc.binary_length(names), 0), one(b"*"), names), one(b"\0"))
    of_name = np.diff(values_of(names)[0])
    which, steps = each(columns["cigar"], lambda cigar: _CIGAR.findall(cigar or ""))
    operations = pa.array([b"".join(struct.pack("<I", int(m) << 4 | OPERATIONS.index(op)) for m, op in x) for x in steps], pa.large_binary()).take(pa.array(which))
    n_steps, on = (np.array(x, np.int64)[which] for x in ([len(x) for x in steps], [sum(int(m) for m, op in x if op in "MDN=X") for x in steps]))
    which, found = each(columns["reference_name"], lambda name: number.get(name, -1))
    reference = np.array(found, np.int64)[which]
    start, flag, mapq = whole("reference_start", -1, -(1 << 31), (1 << 31) - 1), whole("flag", 0, 0, 0xFFFF), whole("mapq", 0, 0, 0xFF)
    if columns["flag"].null_count or of_name.max() > 0xFF or n_steps.max() > 0xFFFF:
        raise ValueError("a flag is missing, or a name or CIGAR is too long for a BAM record")
    # Two bases a byte; an odd number gets one more of code 0.
    bases = pc.fill_null(text("sequence"), b"")
    n_bases = np.diff(values_of(bases)[0])
    offsets, letters = values_of(join(bases, pc.if_else(pa.array(n_bases % 2 == 1), one(b"="), one(b""))))
    codes = _CODES[letters]
    packed = binary(offsets // 2, codes[::2] << 4 | codes[1::2])
    quality = pc.fill_null(text("quality"), b"")
    offsets, phred = values_of(quality)
    if len(phred) and phred.min() < 33:
        raise ValueError("a quality below ! in a BAM record")
    none = np.diff(offsets) == 0
    unknown = np.concatenate([[0], np.cumsum(np.where(none, n_bases, 0))])
    quality = join(binary(offsets, phred - np.uint8(33)), binary(unknown, np.full(unknown[-1], 0xFF, np.uint8)))
    extra = [pc.fill_null(join(one(tag.encode() + b"Z"), text(name), one(b"\0")), b"") for tag, name in zip(tags, ("barcode", "umi"))]
    rest = join(names, operations, packed, quality, *extra)
    core = np.zeros(n, _CORE)
    last = np.maximum(start + on, start + 1) - 1
    core["bin"] = np.where(start < 0, UNPLACED, np.select([start >> bits == last >> bits for _, bits in LEVELS], [first + (start >> bits) for first, bits in LEVELS], 0)) & 0xFFFF
    for name, values in (("size", np.diff(values_of(rest)[0]) + 32), ("ref", reference), ("pos", start), ("name", of_name), ("mapq", mapq), ("steps", n_steps), ("flag", flag), ("bases", n_bases), ("mate", -1), ("mate_pos", -1)):
        core[name] = values
    return values_of(join(binary(np.arange(n + 1) * 36, core.view(np.uint8)), rest))[1].tobytes()


def write_bam(reads: DataFrame, folder: str, references: list[tuple[str, int]], barcode_tag: str = "CB", umi_tag: str = "UB", coordinate_sorted: bool = False) -> list[str]:
    """Writes reads (columns FIELDS) and returns the files' names, in order. With coordinate_sorted the records of all files follow each other by place."""
    number = {name: i for i, (name, _) in enumerate(references)}
    rows = reads.select(*FIELDS)
    if coordinate_sorted:
        place = F.create_map(*(F.lit(x) for pair in number.items() for x in pair))[F.col("reference_name")] if number else F.lit(None).cast("int")
        rows = rows.sort(place.asc_nulls_last(), "reference_start", "read_id").select(*FIELDS)
    return write_blocks(rows, folder, ".bam", header(references, "coordinate" if coordinate_sorted else "unsorted"), lambda batch: records_of(batch, number, (barcode_tag, umi_tag)))
