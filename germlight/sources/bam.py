"""BAM as a Spark data source: spark.read.format("bam").load(path).

A file is a row of BGZF blocks, each a gzip member that states its own length. The driver only lists files and sizes and cuts them into spans of bytes; a task finds the
first block of its span by the blocks' magic and the chain of lengths from there, and its first record as a place where a chain of plausible records begins.
A block belongs to the span it starts in, a record to that of the block it starts in.

Options: barcode_tag and umi_tag (CB, UB), split (bytes a task reads), sequence=false to skip bases and qualities, and
candidates=true with mapq, unmapped and low_mapq to drop other records while decoding. region=chr1 or chr1:101-200 (from 1, both ends included) keeps mapped records
that have a base there, and of files with an index reads only the blocks that hold them. The format bam_places takes the region from filters on reference_name
and reference_start instead; Spark passes them on with spark.sql.python.filterPushdown.enabled. file=true adds the file's path; barcode_slots drops records of
barcodes that aren't in the bitmap (see barcodes) before anything of them is decoded.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StringType, StructField, StructType

from germlight.functions.scalar import SECONDARY, SUPPLEMENTARY, UNMAPPED
from germlight.schemas import READS
from germlight.sources import bai, barcodes
from germlight.sources.files import cuts, open_file

SPLIT, BATCH = 8 << 20, 4096
#: Uncompressed bytes whose records are decoded together.
AT_ONCE = 1 << 20
#: Fixed values of the format: magic, codes of bases and CIGAR operations, sizes of tag values.
BLOCK_MAGIC = b"\x1f\x8b\x08\x04"
MAGIC, BASES, OPERATIONS = b"BAM\1", "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
TAG_VALUES = {b"A": "c", b"c": "b", b"C": "B", b"s": "h", b"S": "H", b"i": "i", b"I": "I", b"f": "f"}
_CORE = struct.Struct("<iiBBHHHiiii")
CORE = np.dtype([("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("steps", "<u2"), ("flag", "<u2"), ("bases", "<i4"), ("mate", "<i4"), ("mate_pos", "<i4"), ("length", "<i4")])
#: Sizes of values by their kind's code, 0 for those without a fixed one; the letters of two packed bases, and of qualities.
SIZES = np.zeros(256, np.int64)
for _kind, _letter in TAG_VALUES.items():
    SIZES[_kind[0]] = struct.calcsize("<" + _letter)
PAIRS = np.array([[ord(BASES[b >> 4]), ord(BASES[b & 15])] for b in range(256)], np.uint8).view(np.uint16)[:, 0]
#: Half a byte a base: a hexadecimal digit each. Qualities are written from `!` on.
_OF_DIGIT = str.maketrans("0123456789abcdef", BASES)
_OF_PHRED = bytes(min(q + 33, 126) for q in range(256))
PHRED = np.frombuffer(_OF_PHRED, np.uint8)
#: Records that must follow one another for a place to count as a record's start, and the longest that one may be.
CHAIN, LONGEST = 5, 1 << 26


class Blocks:
    """The uncompressed bytes of a BGZF file from a block on, with the virtual offset of each."""

    def __init__(self, file, start: int = 0):
        self.file, self.next = file, start
        self.data, self.at = b"", 0
        #: (offset in data, offset of its block in the file)
        self.starts: list[tuple[int, int]] = []

    def more(self) -> bool:
        """Appends a block; False at the end of the file."""
        self.file.seek(self.next)
        head = self.file.read(18)
        if not head:
            return False
        if len(head) < 18 or head[:4] != BLOCK_MAGIC:
            raise ValueError("not a BGZF block")
        size = block_size(head, self.file)
        self.file.seek(self.next)
        raw = self.file.read(size)
        if len(raw) < size:
            raise ValueError("the file ends within a block")
        extra = struct.unpack("<H", raw[10:12])[0]
        part = zlib.decompress(raw[12 + extra : -8], -15)
        if zlib.crc32(part) != struct.unpack("<I", raw[-8:-4])[0]:
            raise ValueError("a block's checksum differs")
        if self.at:
            keep = self.at
            self.data, self.at = self.data[keep:], 0
            old = [(a - keep, b) for a, b in self.starts]
            self.starts = [x for i, x in enumerate(old) if i + 1 == len(old) or old[i + 1][0] > 0]
        self.starts.append((len(self.data), self.next))
        self.data += part
        self.next += size
        return True

    def need(self, n: int) -> bool:
        while len(self.data) - self.at < n:
            if not self.more():
                return False
        return True

    def take(self, n: int) -> bytes:
        if not self.need(n):
            raise ValueError("the file ends within a record")
        out = self.data[self.at : self.at + n]
        self.at += n
        return out

    def place(self) -> tuple[int, int]:
        """(file offset of the block, offset in it) of the next byte."""
        if self.at == len(self.data):
            return self.next, 0
        for a, b in reversed(self.starts):
            if a <= self.at:
                return b, self.at - a
        return self.next, 0


def block_size(head: bytes, file) -> int:
    """Of a block whose first 18 bytes are head and where file stands after them."""
    extra = struct.unpack("<H", head[10:12])[0]
    fields = head[12:18] + file.read(max(0, extra - 6))
    at = 0
    while at + 4 <= extra:
        kind, length = fields[at : at + 2], struct.unpack("<H", fields[at + 2 : at + 4])[0]
        if kind == b"BC":
            return struct.unpack("<H", fields[at + 4 : at + 6])[0] + 1
        at += 4 + length
    raise ValueError("a gzip member without a block size")


def is_block(file, at: int, follow: int = 3) -> bool:
    """Whether blocks begin there, one after another or up to the file's end."""
    for _ in range(follow):
        file.seek(at)
        head = file.read(18)
        if not head:
            return True
        if len(head) < 18 or head[:4] != BLOCK_MAGIC:
            return False
        try:
            at += block_size(head, file)
        except ValueError:
            return False
    return True


def find_block(file, start: int, end: int) -> int:
    """Where the first block at or after start begins; -1 if that isn't before end."""
    at = start
    while at < end:
        file.seek(at)
        chunk = file.read(1 << 17)
        i = chunk.find(BLOCK_MAGIC)
        while i >= 0 and at + i < end:
            if is_block(file, at + i):
                return at + i
            i = chunk.find(BLOCK_MAGIC, i + 1)
        if len(chunk) < len(BLOCK_MAGIC):
            return -1
        at += len(chunk) - len(BLOCK_MAGIC) + 1
    return -1


def read_header(blocks: Blocks) -> list[tuple[str, int]]:
    """References (name, length); leaves the first record next."""
    if blocks.take(4) != MAGIC:
        raise ValueError("not a BAM file")
    blocks.take(struct.unpack("<i", blocks.take(4))[0])
    found = []
    for _ in range(struct.unpack("<i", blocks.take(4))[0]):
        name = blocks.take(struct.unpack("<i", blocks.take(4))[0])[:-1].decode()
        found.append((name, struct.unpack("<i", blocks.take(4))[0]))
    return found


def _plausible(data: bytes, at: int, references: list[tuple[str, int]]) -> int:
    """The end of the record that may start there, or -1."""
    size, ref, pos, name, _, _, cigar, _, bases, next_ref, next_pos, _ = struct.unpack_from("<i", data, at) + _CORE.unpack_from(data, at + 4)
    n = len(references)
    least = 32 + name + 4 * cigar + (bases + 1) // 2 + bases
    if not (least <= size <= LONGEST and -1 <= ref < n and -1 <= next_ref < n and name >= 1 and bases >= 0):
        return -1
    if pos < -1 or next_pos < -1 or (ref >= 0 and pos > references[ref][1]) or (next_ref >= 0 and next_pos > references[next_ref][1]):
        return -1
    end = at + 36 + name
    if end <= len(data) and (data[end - 1] != 0 or any(not 33 <= c <= 126 for c in data[at + 36 : end - 1])):
        return -1
    return at + 4 + size


def find_record(blocks: Blocks, end: int, references: list[tuple[str, int]]) -> bool:
    """Moves to the first record that starts in a block before file offset end; False if there is none."""
    while True:
        if not blocks.need(1) or blocks.place()[0] >= end:
            return False
        at, good = blocks.at, 0
        while good < CHAIN:
            if at + 36 > len(blocks.data):
                before = blocks.at
                if not blocks.more():
                    break  # the chain reaches the file's end
                at -= before
                continue
            at = _plausible(blocks.data, at, references)
            if at < 0:
                break
            good += 1
        if at >= 0 and (good == CHAIN or (good and at == len(blocks.data))):
            return True
        blocks.at += 1


def tags(data: bytes, at: int) -> dict[str, str]:
    """All tags from there to the end, as text."""
    found = {}
    while at + 3 <= len(data):
        name, kind = data[at : at + 2].decode(), data[at + 2 : at + 3]
        at += 3
        if kind in (b"Z", b"H"):
            end = data.index(b"\0", at)
            found[name], at = data[at:end].decode(), end + 1
        elif kind == b"B":
            sub, n = data[at : at + 1], struct.unpack_from("<i", data, at + 1)[0]
            values = struct.unpack_from(f"<{n}{TAG_VALUES[sub]}", data, at + 5)
            found[name], at = ",".join(map(str, values)), at + 5 + n * struct.calcsize(TAG_VALUES[sub])
        elif kind in TAG_VALUES:
            value = struct.unpack_from("<" + TAG_VALUES[kind], data, at)[0]
            found[name], at = value.decode() if isinstance(value, bytes) else str(value), at + struct.calcsize(TAG_VALUES[kind])
        else:
            raise ValueError(f"a tag of unknown type {kind!r}")
    return found


def tag_text(data: bytes, at: int, wanted: bytes) -> bytes:
    """The last value of a tag as text, or nothing; other tags are passed over."""
    found = b""
    while at + 3 <= len(data):
        name, kind = data[at : at + 2], data[at + 2 : at + 3]
        at += 3
        if kind in (b"Z", b"H"):
            end = data.index(b"\0", at)
            if name == wanted:
                found = data[at:end]
            at = end + 1
        elif kind == b"B":
            at += 5 + struct.unpack_from("<i", data, at + 1)[0] * struct.calcsize(TAG_VALUES[data[at : at + 1]])
        elif kind in TAG_VALUES:
            size = struct.calcsize(TAG_VALUES[kind])
            if name == wanted:
                found = data[at : at + 1] if kind == b"A" else str(struct.unpack_from("<" + TAG_VALUES[kind], data, at)[0]).encode()
            at += size
        else:
            raise ValueError(f"a tag of unknown type {kind!r}")
    return found


class Span(InputPartition):
    """Bytes of a file. inside: where in the first block its first record starts, if that is known; until: the virtual offset to stop at, if any."""

    def __init__(self, path: str, start: int, end: int, inside: int | None = None, until: int | None = None):
        self.path, self.start, self.end, self.inside, self.until = path, start, end, inside, until


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self):
        return StructType([*READS, StructField("file", StringType())]) if _yes(self.options, "file", "false") else READS

    def reader(self, schema) -> BamReader:
        return BamReader(self.options, schema)


class BamPlaces(BamSource):
    @classmethod
    def name(cls) -> str:
        return "bam_places"

    def reader(self, schema) -> BamReader:
        return PlacesReader(self.options, schema)


class BamParts(DataSource):
    """What an index is made of; see bai."""

    @classmethod
    def name(cls) -> str:
        return "bam_parts"

    def schema(self):
        return bai.PARTS

    def reader(self, schema) -> BamReader:
        return PartsReader(self.options, schema)


def _yes(options, name: str, default: str) -> bool:
    return str(options.get(name, default)).lower() == "true"


def region_of(text: str) -> tuple[str, int, int]:
    """(reference, start, end) of a region's text, from 0 and without the end; digits after the last colon are places, not a name's."""
    name, colon, places = text.rpartition(":")
    first, dash, last = places.replace(",", "").partition("-")
    if not colon or not first.isdigit() or (last and not last.isdigit()):
        return text, 0, bai.LIMIT
    return name, max(0, int(first) - 1), int(last) if last else (bai.LIMIT if dash else int(first))


def _length(operations: bytes) -> int:
    """Of a record's bases on its reference: at least one."""
    return max(1, sum(c >> 4 for c in struct.unpack(f"<{len(operations) // 4}I", operations) if OPERATIONS[c & 15] in "MDN=X"))


@dataclass
class Chunk:
    """Records in data: where the bytes of each begin and end, and the virtual offsets of its start and end."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray
    references: list[tuple[str, int]]

    def core(self) -> np.ndarray:
        return np.frombuffer(self.data, np.uint8)[self.starts[:, None] + np.arange(32)].view(CORE)[:, 0]

    def some(self, keep: np.ndarray) -> Chunk:
        return Chunk(self.data, self.starts[keep], self.ends[keep], self.first[keep], self.last[keep], self.references)


def _texts(data: bytes, starts: np.ndarray, ends: np.ndarray, has: np.ndarray | None = None):
    """Stretches of data, one after another, as texts; null where has is false."""
    import pyarrow as pa
    import pyarrow.compute as pc

    edges = np.empty(2 * len(starts) + 1, np.int32)
    edges[0:-1:2], edges[1::2] = starts, ends
    edges[-1] = edges[-2]
    found = pa.StringArray.from_buffers(2 * len(starts), pa.py_buffer(edges), pa.py_buffer(data)).take(pa.array(np.arange(0, 2 * len(starts), 2)))
    found.validate(full=True)
    return found if has is None else pc.if_else(pa.array(has), found, pa.scalar(None, pa.string()))


def _bases(data: bytes, bases: np.ndarray, phred: np.ndarray, after: np.ndarray, n: np.ndarray) -> tuple:
    """(sequences, qualities) of packed bases from `bases` to `phred` and n qualities from there on."""
    import pyarrow as pa
    import pyarrow.compute as pc

    raw = np.frombuffer(data, np.uint8)
    ends = np.concatenate([[0], np.cumsum(phred - bases)])
    letters = PAIRS[raw[np.arange(ends[-1]) + np.repeat(bases - ends[:-1], phred - bases)]].view(np.uint8).tobytes()
    sequences = _texts(letters, 2 * ends[:-1], 2 * ends[:-1] + n)
    ends = np.concatenate([[0], np.cumsum(after - phred)])
    letters = PHRED[raw[np.arange(ends[-1]) + np.repeat(phred - ends[:-1], after - phred)]].tobytes()
    none = (n > 0) & (raw[np.minimum(phred, len(raw) - 1)] == 0xFF)
    return sequences, pc.if_else(pa.array(none), "", _texts(letters, ends[:-1], ends[1:]))


def _next(places: np.ndarray, at: np.ndarray, none: int) -> np.ndarray:
    """The first of places at or after each of at; none if there isn't one."""
    return np.append(places, none)[np.searchsorted(places, at)]


def _before_dash(chunk: Chunk, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    dashes = np.flatnonzero(np.frombuffer(chunk.data, np.uint8) == 45)
    return starts, np.minimum(ends, _next(dashes, starts, len(chunk.data)))


def _text_tags(chunk: Chunk, at: np.ndarray, wanted: tuple[str, ...]) -> tuple[list[tuple[tuple[np.ndarray, np.ndarray], np.ndarray]], np.ndarray]:
    """For each wanted tag ((starts, ends) of its last text, which records have it), its place being the record's end if not; and the records to be decoded alone, since such a tag is no
    text or one can't be read. The n-th tags of all records are read together."""
    raw = np.frombuffer(chunk.data, np.uint8)
    zeros, odd, at = np.flatnonzero(raw == 0), np.zeros(len(at), bool), at.copy()
    found = [((chunk.ends.copy(), chunk.ends.copy()), np.zeros(len(at), bool)) for _ in wanted]
    codes = [int.from_bytes(x.encode()) if len(x.encode()) == 2 else -1 for x in wanted]
    live = np.flatnonzero(at + 3 <= chunk.ends)
    while len(live):
        here, end = at[live], chunk.ends[live]
        name, kind = raw[here].astype(np.int64) << 8 | raw[here + 1], raw[here + 2]
        text = (kind == 90) | (kind == 72)
        close = _next(zeros, here + 3, len(raw))
        after = np.where(text, close + 1, here + 3 + SIZES[kind])
        array = np.flatnonzero(kind == 66)
        for i in array.tolist():
            place = int(here[i]) + 3
            size = int(SIZES[raw[place]]) if place + 5 <= end[i] else 0
            after[i] = place + 5 + struct.unpack_from("<i", chunk.data, place + 1)[0] * size if size else 0
        bad = (after > end) | (after <= here + 3) | (raw[np.minimum(here, len(raw) - 1)] > 127) | (raw[here + 1] > 127)
        for ((starts, ends), has), code in zip(found, codes):
            mine = (name == code) & ~bad
            bad |= mine & ~text
            mine &= text
            starts[live[mine]], ends[live[mine]], has[live[mine]] = here[mine] + 3, close[mine], True
        odd[live[bad]] = True
        at[live] = after
        live = live[~bad & (after + 3 <= end)]
    return found, odd


class BamReader(DataSourceReader):
    def __init__(self, options, schema=READS):
        self.path, self.split, self.schema = options["path"], int(options.get("split", SPLIT)), schema
        self.barcode, self.umi = options.get("barcode_tag", "CB"), options.get("umi_tag", "UB")
        self.with_sequence, self.candidates, self.with_file = _yes(options, "sequence", "true"), _yes(options, "candidates", "false"), _yes(options, "file", "false")
        self.mapq, self.unmapped, self.low_mapq = int(options.get("mapq", 30)), _yes(options, "unmapped", "true"), _yes(options, "low_mapq", "true")
        self.slots = options.get("barcode_slots")
        self.region: tuple[str, int, int] | None = region_of(options["region"]) if options.get("region") else None

    def partitions(self) -> list[Span]:
        files, split = cuts(self.path, self.split, (".bam",))
        return [span for path, size in files for span in self._spans(path, size, split)]

    def _spans(self, path: str, size: int, split: int) -> Iterator[Span]:
        index = bai.read_index(path) if self.region else None
        if index is None:
            yield from (Span(path, at, min(at + split, size)) for at in range(0, size, split))
            return
        with open_file(path) as raw:
            names = [name for name, _ in read_header(Blocks(io.BufferedReader(raw, 1 << 16)))]
        name, start, end = self.region
        for first, last in index.chunks(names.index(name) if name in names else -1, start, end):
            stop = (last >> 16) + 1
            for at in range(first >> 16, stop, self.split):
                yield Span(path, at, min(at + self.split, stop), first & 0xFFFF if at == first >> 16 else None, last)

    def chunks(self, span: Span, at_once: int = AT_ONCE) -> Iterator[Chunk]:
        """The records that start in the span, many at a time."""
        with open_file(span.path) as raw:
            file = io.BufferedReader(raw, 1 << 20)
            blocks = Blocks(file)
            references = read_header(blocks)
            if span.inside is not None:
                blocks = Blocks(file, span.start)
                blocks.need(span.inside)
                blocks.at = span.inside
            elif span.start:
                first = find_block(file, span.start, span.end)
                if first < 0:
                    return
                blocks = Blocks(file, first)
                if not find_record(blocks, span.end, references):
                    return
            size_of = struct.Struct("<i").unpack_from
            while True:
                while len(blocks.data) - blocks.at < at_once and blocks.next < span.end and blocks.more():
                    pass
                data, at, starts = blocks.data, blocks.at, []
                size, append = len(data), starts.append
                while at + 4 <= size:
                    after = at + 4 + size_of(data, at)[0]
                    if after > size:
                        break
                    if after < at + 36:
                        raise ValueError("a record that is too short")
                    append(at)
                    at = after
                edges = np.array([*starts, at], np.int64)
                of_data, of_file = (np.array(x, np.int64) for x in zip(*blocks.starts)) if blocks.starts else (np.zeros(0, np.int64),) * 2
                block = np.searchsorted(of_data, edges, "right") - 1
                places = of_file[block] << 16 | edges - of_data[block] if len(of_data) else edges
                if at == len(data):
                    places[-1] = blocks.next << 16
                own = (places[:-1] >> 16 < span.end) & ((places[:-1] < span.until) if span.until is not None else True)
                n = int(np.argmin(own)) if not own.all() else len(own)
                if n:
                    blocks.at = int(edges[n])
                    yield Chunk(data, edges[:n] + 4, edges[1 : n + 1], places[:n], places[1 : n + 1], references)
                if n < len(own) or (places[n] >> 16) >= span.end or (span.until is not None and places[n] >= span.until):
                    return
                if not blocks.more():
                    if blocks.at < len(blocks.data):
                        raise ValueError("the file ends within a record")
                    return

    def batches(self, span: Span) -> Iterator:
        """Columns of READS, of many records at once. Records with a tag that isn't plain text where text is looked for are decoded one by one."""
        import pyarrow as pa
        import pyarrow.compute as pc

        known = barcodes.slots(self.slots) if self.slots else None
        cigars: dict[bytes, tuple[str | None, int]] = {}
        fields = READS.fieldNames()
        for chunk in self.chunks(span):
            data, core = chunk.data, chunk.core()
            flag, mapq, ref, pos = (core[x].astype(np.int64) for x in ("flag", "mapq", "ref", "pos"))
            keep = np.ones(len(core), bool)
            if self.candidates:
                keep = (flag & (SECONDARY | SUPPLEMENTARY) == 0) & np.where(flag & UNMAPPED != 0, self.unmapped, self.low_mapq & (mapq < self.mapq))
            if self.region is not None:
                reference, start, end = self.region
                inside = np.array([name == reference for name, _ in chunk.references] + [False])
                keep &= (flag & UNMAPPED == 0) & (ref >= 0) & inside[ref] & (pos < end)
            if not keep.all():
                chunk, core, flag, mapq, ref, pos = chunk.some(keep), core[keep], flag[keep], mapq[keep], ref[keep], pos[keep]
            if not len(core):
                continue
            operations = chunk.starts + 32 + core["name"]
            bases = operations + 4 * core["steps"].astype(np.int64)
            phred = bases + (core["bases"].astype(np.int64) + 1) // 2
            after = phred + core["bases"]
            if np.any(core["bases"] < 0) or np.any(after > chunk.ends) or np.any(core["name"] < 1):
                raise ValueError("a record that is shorter than its fields")
            texts, odd = _text_tags(chunk, after, (self.barcode, self.umi, "CG"))
            odd |= texts[2][1]
            (barcode_at, has_barcode), (umi_at, has_umi) = texts[:2]
            barcode = _texts(data, *_before_dash(chunk, *barcode_at), has_barcode)
            if known is not None:
                # Records of other cells go before anything else of them is decoded.
                coded = barcode.cast(pa.binary()).dictionary_encode()
                slot = np.array([False, *(barcodes.maybe(x, known) for x in coded.dictionary.to_pylist())])
                keep = slot[pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False) + 1] | odd
                for i in np.flatnonzero(odd).tolist():
                    keep[i] = barcodes.maybe(tag_text(data[: chunk.ends[i]], int(after[i]), self.barcode.encode()), known)
                if not keep.any():
                    continue
                if not keep.all():
                    chunk, barcode, umi_at = chunk.some(keep), barcode.filter(pa.array(keep)), tuple(x[keep] for x in umi_at)
                    core, flag, mapq, ref, pos, operations, bases, phred, after, has_umi, odd = (x[keep] for x in (core, flag, mapq, ref, pos, operations, bases, phred, after, has_umi, odd))
            steps = []
            for a, b in zip(operations.tolist(), bases.tolist()):
                own = data[a:b]
                found = cigars.get(own)
                if found is None:
                    codes = struct.unpack(f"<{len(own) // 4}I", own)
                    found = "".join(f"{c >> 4}{OPERATIONS[c & 15]}" for c in codes) or None, max(1, sum(c >> 4 for c in codes if OPERATIONS[c & 15] in "MDN=X"))
                    if len(cigars) > BATCH:
                        cigars.clear()
                    cigars[own] = found
                steps.append(found)
            keep = np.ones(len(core), bool)
            if self.region is not None:
                keep &= pos + np.array([on for _, on in steps], np.int64) > self.region[1]
            unmapped = flag & UNMAPPED != 0
            names = pa.array([name for name, _ in chunk.references], pa.string())
            flags = lambda x: pa.array(np.asarray(x, bool))
            columns = {
                "read_id": _texts(data, chunk.starts + 32, operations - 1), "ordinal": pa.array(chunk.first), "barcode": barcode, "umi": _texts(data, *umi_at, has_umi), "flag": pa.array(flag.astype(np.int32)), "mapq": pa.array(mapq.astype(np.int32)),
                "is_unmapped": flags(unmapped), "is_secondary": flags(flag & SECONDARY), "is_supplementary": flags(flag & SUPPLEMENTARY), "reference_name": names.take(pa.array(np.maximum(ref, 0), mask=unmapped | (ref < 0))) if len(names) else pa.nulls(len(core), pa.string()),
                "reference_start": pa.array(pos.astype(np.int32), mask=unmapped), "cigar": pc.if_else(flags(unmapped), pa.scalar(None, pa.string()), pa.array([x for x, _ in steps], pa.string())),
            }
            columns |= dict(zip(("sequence", "quality"), _bases(data, bases, phred, after, core["bases"]))) if self.with_sequence else dict.fromkeys(("sequence", "quality"), pa.nulls(len(core), pa.string()))
            made = pa.RecordBatch.from_arrays([columns[name] for name in fields], names=fields)
            if np.any(odd & keep):
                at = np.flatnonzero(odd & keep)
                alone = [self._row(data[chunk.starts[i] : chunk.ends[i]], int(chunk.first[i]), chunk.references, int(ref[i]), int(pos[i]), int(core["name"][i]), int(mapq[i]), int(core["steps"][i]), int(flag[i]), int(core["bases"][i])) for i in at.tolist()]
                order = np.arange(len(core))
                order[at] = len(core) + np.arange(len(at))
                made = pa.RecordBatch.from_arrays([pa.concat_arrays([c, pa.array(x, c.type)]) for c, x in zip(made.columns, zip(*alone))], names=fields).take(pa.array(order))
            if not keep.all():
                made = made.filter(pa.array(keep))
            yield made

    def _row(self, data, ordinal, references, ref, pos, name, mapq, n_cigar, flag, n_bases) -> tuple:
        at = 32 + name
        cigar = "".join(f"{c >> 4}{OPERATIONS[c & 15]}" for c in struct.unpack_from(f"<{n_cigar}I", data, at)) or None
        at += 4 * n_cigar
        packed, at = data[at : at + (n_bases + 1) // 2], at + (n_bases + 1) // 2
        phred = data[at : at + n_bases]
        sequence = quality = None
        if self.with_sequence:
            sequence = packed.hex().translate(_OF_DIGIT)[:n_bases]
            quality = "" if phred[:1] == b"\xff" else phred.translate(_OF_PHRED).decode()
        extra = tags(data, at + n_bases)
        mapped = not flag & UNMAPPED
        barcode = extra.get(self.barcode)
        if n_cigar == 2 and "CG" in extra:  # more operations than a record can count
            cigar = "".join(f"{int(c) >> 4}{OPERATIONS[int(c) & 15]}" for c in extra["CG"].split(","))
        return (
            data[32 : 31 + name].decode(), ordinal, sequence, quality, barcode.split("-", 1)[0] if barcode is not None else None, extra.get(self.umi), flag, mapq, not mapped, bool(flag & SECONDARY), bool(flag & SUPPLEMENTARY),
            references[ref][0] if mapped and ref >= 0 else None, pos if mapped else None, cigar if mapped else None,
        )

    def read(self, partition: Span) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition is None:  # Spark's stand-in where there is nothing to read
            return
        schema = to_arrow_schema(self.schema)
        for batch in self.batches(partition):
            file = [pa.array([partition.path] * len(batch), pa.string())] if self.with_file else []
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*batch.columns, *file], schema)], schema=schema)


class PlacesReader(BamReader):
    """Takes its region from filters. Spark applies them all the same: a region only spares blocks and records."""

    def pushFilters(self, filters: list) -> list:
        names, low, high = set(), 0, bai.LIMIT
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("reference_name",):
                names.add(f.value)
            elif isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.attribute == ("reference_start",):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    low = max(low, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    high = min(high, f.value + (not isinstance(f, LessThan)))
        if len(names) == 1:
            self.region = (names.pop(), low, max(high, low + 1))
        return filters


class PartsReader(BamReader):
    def rows(self, span: Span) -> Iterator[tuple]:
        def each() -> Iterator[tuple[np.ndarray, ...]]:
            lengths: dict[bytes, int] = {}
            for chunk in self.chunks(span):
                core, data = chunk.core(), chunk.data
                ref, pos, flag = (core[x].astype(np.int64) for x in ("ref", "pos", "flag"))
                mapped = np.flatnonzero(flag & UNMAPPED == 0)
                at = (chunk.starts + 32 + core["name"])[mapped]
                on = np.ones(len(core), np.int64)
                found = []
                for a, b in zip(at.tolist(), (at + 4 * core["steps"][mapped].astype(np.int64)).tolist()):
                    own = data[a:b]
                    if (n := lengths.get(own)) is None:
                        if len(lengths) > BATCH:
                            lengths.clear()
                        n = lengths[own] = _length(own)
                    found.append(n)
                on[mapped] = found
                yield chunk.first, chunk.last, ref, pos, pos + on, flag

        if span.start == 0:
            yield span.path, None, None, None, None, None  # a file without records has an index too
        yield from bai.parts_of(span, each())

    def read(self, partition: Span) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition is None:
            return
        schema, rows = to_arrow_schema(self.schema), list(self.rows(partition))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
