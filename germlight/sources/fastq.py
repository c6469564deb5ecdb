"""FASTQ as a Spark data source: spark.read.format("fastq").load(path).

Files are cut into spans of `split` bytes. In a plain file a record belongs to the span it starts in. In one of gzip blocks that state their length (BGZF) it belongs to the span in which the
block begins that holds the byte before it, and the file's first record to the first span, so that a task needs nothing of the spans before its own. Any
other gzip file can only be read from its start: its first span reads it whole, the others find no block and give nothing.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from germlight.schemas import FASTQ
from germlight.sources.bam import Blocks, find_block, is_block
from germlight.sources.files import cuts, open_file

#: Bytes of a file that a task reads.
SPLIT = 64 << 20
BATCH = 4096
#: Bytes that are taken apart at once, where records are plain.
AT_ONCE = 1 << 20
NAMES = ["name", "sequence", "plus", "quality"]


class Span(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return FASTQ

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options["path"], int(self.options.get("split", SPLIT)))


def _line(text: bytes) -> str:
    return text.rstrip(b"\r\n").decode()


class BlockLines:
    """Lines of a file of gzip blocks, from the block at start on. A place is (block of the byte before it, block and offset of the next byte)."""

    def __init__(self, file, start: int):
        self.blocks, self.held = Blocks(file, start), -1

    def readline(self) -> bytes:
        own, seen = self.blocks, self.blocks.at
        while (end := own.data.find(b"\n", seen)) < 0:
            seen = len(own.data) - own.at  # more() drops what lies before the place
            if not own.more():
                end = len(own.data) - 1
                break
        if end < own.at:
            return b""
        self.held = next(block for at, block in reversed(own.starts) if at <= end)
        line, own.at = own.data[own.at : end + 1], end + 1
        return line

    def tell(self) -> tuple[int, int, int]:
        return self.held, *self.blocks.place()

    def seek(self, place: tuple[int, int, int]) -> None:
        self.held, block, inside = place
        self.blocks = Blocks(self.blocks.file, block)
        self.blocks.take(inside)


def records(stream, path: str, stop: int | tuple[int] | None = None) -> Iterator[tuple[str, str, str, str]]:
    """Four-line records from the stream's place on that start before stop; a last line needs no line end."""
    while stop is None or stream.tell() < stop:
        name = stream.readline()
        if not name:
            return
        if not name.strip():
            continue
        rest = [stream.readline() for _ in range(3)]
        if not name.startswith(b"@"):
            raise ValueError(f"{path}: a record begins with {name[:20]!r} instead of @")
        if not rest[1].startswith(b"+"):
            raise ValueError(f"{path}: record {_line(name)} has no + line")
        yield _line(name)[1:], _line(rest[0]), _line(rest[1]), _line(rest[2])


def find_record(stream) -> None:
    """From within a line to the first record that starts after it. A line with @ may be a quality line; the first line of a record has + two lines on."""
    stream.readline()
    lines: list[tuple[int | tuple, bytes]] = []
    while True:
        at = stream.tell()
        line = stream.readline()
        lines = [*lines[-2:], (at, line)]
        if not line:
            return
        if len(lines) == 3 and lines[0][1].startswith(b"@") and line.startswith(b"+"):
            # A quality line that begins with @ is followed by a name, not by bases: then the line between begins with @ too.
            if not lines[1][1].startswith(b"@"):
                stream.seek(lines[0][0])
                return


def _columns(own: Blocks, end: int, at_once: int = AT_ONCE):
    """Batches of the records that lie whole in the blocks before end, a column at a time; leaves the place of the first one that doesn't, or that isn't four plain lines."""
    import pyarrow as pa

    least = at_once
    while True:
        while own.next < end and len(own.data) - own.at < least and own.more():
            pass
        data, begin = own.data, own.at
        bytes_ = np.frombuffer(data, np.uint8)[begin:]
        ends = np.flatnonzero(bytes_ == 10)
        # A record is the span's own if the byte before it is.
        limit = next((at for at, block in own.starts if block >= end), len(data)) - begin
        n = min(len(ends) // 4, 1 + int(np.searchsorted(ends[3::4] + 1, limit, "right")))
        if not n or limit < 0:
            if len(bytes_) < least:
                return
            least *= 2
            continue
        ends = ends[: 4 * n]
        starts = np.concatenate([[0], ends[:-1] + 1])
        if np.any(bytes_[starts[::4]] != 64) or np.any(bytes_[starts[2::4]] != 43) or data.find(b"\r", begin, begin + int(ends[-1])) >= 0:
            return
        # Every byte belongs to one of nine texts of a record: @, four lines, four line ends.
        edges = np.empty((n, 9), np.int32)
        edges[:, 0], edges[:, 1] = starts[::4], starts[::4] + 1
        edges[:, 2::2], edges[:, 3::2] = ends.reshape(n, 4), starts.reshape(n, 4)[:, 1:]
        texts = pa.StringArray.from_buffers(9 * n, pa.py_buffer(np.append(edges.ravel(), np.int32(ends[-1] + 1))), pa.py_buffer(bytes_))
        if bytes_.max() > 127:
            texts.validate(full=True)
        own.at, least = begin + int(ends[-1]) + 1, at_once
        yield pa.RecordBatch.from_arrays([texts.take(pa.array(np.arange(i, 9 * n, 9))) for i in (1, 3, 5, 7)], names=NAMES)


def _records_of(file, span: Span) -> Iterator:
    """The span's own records, as rows or as batches of them."""
    if not span.path.endswith(".gz"):
        stream = io.BufferedReader(file)
        if span.start:
            stream.seek(span.start - 1)
            find_record(stream)
        yield from records(stream, span.path, span.end)
        return
    if not is_block(file, 0, follow=1):
        file.seek(0)
        if not span.start:
            yield from records(io.BufferedReader(gzip.GzipFile(fileobj=file)), span.path)
        return
    first = find_block(file, span.start, span.end)
    if first < 0:
        return
    lines = BlockLines(file, first)
    if span.start:
        find_record(lines)
    if lines.tell() < (span.end,):
        own = lines.blocks
        for batch in _columns(own, span.end):
            lines.held = next(block for at, block in reversed(own.starts) if at < own.at)
            yield batch
        yield from records(lines, span.path, (span.end,))


class FastqReader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[Span]:
        files, split = cuts(self.path, self.split)
        return [Span(path, at, min(at + split, size)) for path, size in files for at in range(0, size, split)]

    def read(self, partition: Span) -> Iterator:
        import pyarrow as pa

        if partition is None:  # Spark's stand-in where there is nothing to read
            return
        made = lambda batch: pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*batch)], names=NAMES)
        with open_file(partition.path) as file:
            batch: list[tuple] = []
            for row in _records_of(file, partition):
                if isinstance(row, pa.RecordBatch):
                    yield row
                    continue
                batch.append(row)
                if len(batch) == BATCH:
                    yield made(batch)
                    batch = []
            if batch:
                yield made(batch)
