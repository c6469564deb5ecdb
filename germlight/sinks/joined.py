"""One file of many parts: Spark writes the parts, in order, and they are joined without their content passing through the driver's memory.

The driver knows each part's size, so each has its place in the file. On a `file:` path, which names storage that all machines mount, and in local mode, tasks copy the parts to
their places in parallel; writing a part twice gives the same bytes, so a lost task is just run again. A plain path of a cluster's driver, and a store whose files can't be written in places, get the
parts streamed in order by COPY bytes at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession

from germlight.functions.storage import delete, passing_folder
from germlight.sources.files import _store, list_files, open_file

#: Bytes that are in memory at a time while parts are copied, and the bytes of a part that a task copies.
COPY, PIECE = 8 << 20, 256 << 20
#: (path, offset in it, bytes) of a written part, or bytes that stand for themselves.
Piece = tuple[str, int, int] | bytes


class Scratch:
    """Folders of parts, deleted together."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for folder in self.folders:
            delete(self.spark, folder)

    def parts(self, rows: DataFrame, text: Column, end: str = "\n", label: str = "parts") -> list[Piece]:
        """The rows' text, each followed by end, in the order of rows' partitions."""
        folder = passing_folder(self.spark, label)
        self.folders.append(folder)
        rows.select(text.alias("value")).write.text(folder, lineSep=end)
        return [(path, 0, size) for path, size in list_files(folder) if size]


def _size(piece: Piece) -> int:
    return len(piece) if isinstance(piece, bytes) else piece[2]


def _content(piece: Piece) -> Iterator[bytes]:
    if isinstance(piece, bytes):
        yield piece
        return
    path, at, left = piece
    with open_file(path) as file:
        file.seek(at)
        while left:
            content = file.read(min(COPY, left))
            if not content:
                raise ValueError(f"{path} is shorter than it was")
            left -= len(content)
            yield content


def without_last_byte(pieces: Sequence[Piece]) -> list[Piece]:
    """The same without the last one's last byte."""
    if not pieces:
        return []
    last = pieces[-1]
    return [*pieces[:-1], last[:-1] if isinstance(last, bytes) else (last[0], last[1], last[2] - 1)]


def write_joined(spark: SparkSession, pieces: Sequence[Piece], path: str) -> int:
    """Writes pieces after each other to one file, which appears when it is whole; its size."""
    local = spark.sparkContext.master.partition("[")[0] == "local"
    scheme = urlparse(path).scheme
    in_places = scheme == "file" or (scheme == "" and local)
    store, target = _store(path)
    folder, _, name = target.rpartition("/")
    if folder:
        store.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}" if folder else f".{name}-{uuid.uuid4().hex}"
    size = sum(map(_size, pieces))
    if in_places:
        _copy_in_places(spark, pieces, part, size)
    else:
        with store.open_output_stream(part, compression=None) as out:
            for piece in pieces:
                for content in _content(piece):
                    out.write(content)
    store.move(part, target)
    return size


def _copy_in_places(spark: SparkSession, pieces: Sequence[Piece], target: str, size: int) -> None:
    at, todo = 0, []
    with open(target, "wb") as out:
        out.truncate(size)
        for piece in pieces:
            if isinstance(piece, bytes):
                out.seek(at)
                out.write(piece)
            else:
                todo += [(piece[0], piece[1] + i, min(PIECE, piece[2] - i), at + i) for i in range(0, piece[2], PIECE)]
            at += _size(piece)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with open(target, "r+b") as out:
                for source, start, length, place in zip(*(c.to_pylist() for c in batch.columns)):
                    out.seek(place)
                    for content in _content((source, start, length)):
                        out.write(content)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    if todo:
        rows = spark.createDataFrame(todo, "source string, start long, length long, place long").repartition(len(todo))  # a row a part
        done = sum(r["n"] for r in rows.mapInArrow(copy, "n long").collect())
        if done != len(todo):
            raise RuntimeError(f"{done} of {len(todo)} parts were copied")
