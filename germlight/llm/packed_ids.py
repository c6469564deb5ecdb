"""Token ids in fixed-width bit-packed files.

A file holds the documents of one range of (id, hash of text), in ascending order:

    magic "GLPK", version u16, bits u16, block u32                      12 bytes
    blocks: ids packed in `bits` bits each, least significant first, padded to whole bytes; `block` ids in each, fewer in the last
    block offsets u64, one a block and the end                          where each block starts in the file
    documents: id i64, first id u64, ids u32, crc32 u32                 24 bytes each; the crc32 is of the ids as little-endian u32
    footer: offset of the block offsets u64, number of blocks u64, of documents u64, of ids u64, magic

`bits` is the least that the vocabulary needs. With the offsets, any run of ids is read from the blocks that hold it, unpacked in numpy.

Tasks write files of unique names to the shared folder; the driver gets one short row for each file of a task that succeeded, which makes the
manifest (so a lost executor's half-written file is never read), and from it where each file's first id lies among all.

Defined cases: a null or empty text encodes to the end id alone; repeated rows are each written, ties in order of their text's hash; a null doc_id
sorts first and is written as the smallest i64; an empty table gives no file and an empty result; columns other than the named ones are ignored.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from germlight.llm._shared import Generations, filesystem, fresh_dir, table
from germlight.llm.characters import Splitter

MAGIC, VERSION, BLOCK = b"GLPK", 1, 1 << 16
HEADER, DOCUMENT, FOOTER = struct.Struct("<4sHHI"), np.dtype([("id", "<i8"), ("first", "<u8"), ("n", "<u4"), ("crc", "<u4")]), struct.Struct("<QQQQ4s")
#: Documents that are encoded, or returned, at a time; distinct pieces of text whose ids a worker keeps.
DOCS, CACHE = 256, 600_000
END_ID, NULL_ID = 2, -(2**63)
#: Fixed value: what byte-level BPE vocabularies of this kind split a text by before their merges. Words lead, being the most; no two branches match at one place otherwise.
PIECES = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    ids = ids.astype("<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    return np.packbits((ids[:, None] >> np.arange(bits, dtype=np.uint32)).astype(np.uint8) & 1, bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """n ids as u32."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return flat.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class Writer:
    """Appends documents to a binary stream; holds one block and the short list of documents."""

    def __init__(self, out, bits: int, block: int = BLOCK):
        self.out, self.bits, self.block = out, bits, block
        self.at, self.n, self.pending, self.held = HEADER.size, 0, [], 0
        self.offsets: list[int] = []
        self.documents: list[tuple[int, int, int, int]] = []
        out.write(HEADER.pack(MAGIC, VERSION, bits, block))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        ids = ids.astype("<u4", copy=False)
        self.documents.append((NULL_ID if doc_id is None else doc_id, self.n, len(ids), zlib.crc32(ids.tobytes())))
        self.pending.append(ids)
        self.n, self.held = self.n + len(ids), self.held + len(ids)
        if self.held >= self.block:
            both = np.concatenate(self.pending)
            whole = len(both) // self.block * self.block
            for at in range(0, whole, self.block):
                self._put(both[at : at + self.block])
            self.pending, self.held = [both[whole:]], len(both) - whole

    def _put(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.offsets.append(self.at)
        self.at += len(data)
        self.out.write(data)

    def close(self) -> int:
        """The file's size."""
        if self.held:
            self._put(np.concatenate(self.pending))
        blocks = len(self.offsets)
        tail = np.array([*self.offsets, self.at], "<u8").tobytes() + np.array(self.documents, DOCUMENT).tobytes() + FOOTER.pack(self.at, blocks, len(self.documents), self.n, MAGIC)
        self.out.write(tail)
        return self.at + len(tail)


class Reader:
    """Random access to a packed file."""

    def __init__(self, file):
        self.file = file
        end = file.seek(0, 2) or file.tell()
        file.seek(end - FOOTER.size)
        tail, self.blocks, n_docs, self.n, magic = FOOTER.unpack(file.read(FOOTER.size))
        file.seek(0)
        first, _, self.bits, self.block = HEADER.unpack(file.read(HEADER.size))
        if magic != MAGIC or first != MAGIC:
            raise ValueError("not a packed file")
        file.seek(tail)
        self.offsets = np.frombuffer(file.read(8 * (self.blocks + 1)), "<u8").astype(np.int64)
        self.documents = np.frombuffer(file.read(DOCUMENT.itemsize * n_docs), DOCUMENT)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start ... stop - 1 of the file, from the blocks that hold them."""
        if stop <= start:
            return np.zeros(0, "<u4")
        a, b = start // self.block, (stop - 1) // self.block + 1
        self.file.seek(int(self.offsets[a]))
        data = self.file.read(int(self.offsets[b] - self.offsets[a]))
        base = int(self.offsets[a])
        parts = [unpack(data[int(self.offsets[k]) - base : int(self.offsets[k + 1]) - base], self.bits, min(self.block, self.n - k * self.block)) for k in range(a, b)]
        return np.concatenate(parts)[start - a * self.block : stop - a * self.block]

    def document(self, k: int) -> np.ndarray:
        d = self.documents[k]
        return self.ids(int(d["first"]), int(d["first"]) + int(d["n"]))


def byte_characters() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: itself where Latin-1 prints it, else the next one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(others)}


class Encoder:
    """text -> ids by a tokenizers file, as the library's encode(text, add_special_tokens=False) gives them.

    A byte-level BPE encodes the pieces of its pattern on their own, so a worker asks the library once for each distinct piece and keeps the answers over
    its tasks, CACHE at most (some 150 MB). Whole texts go to the library where they hold one of the file's added tokens, which it matches before its
    pattern (with special_as_text the special ones are ordinary text), and for any other kind of tokenizer.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        # Tasks are the parallelism; threads beneath them would only add memory and switching.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not (special_as_text and t.special)]
        self.vocabulary = self.tokenizer.get_vocab_size()
        split = str(self.tokenizer.pre_tokenizer)
        self.by_piece = "ByteLevel" in split and "add_prefix_space=True" not in split and self.tokenizer.normalizer is None
        self.pieces, self.merges, self.stand_for = Splitter(PIECES, self._pieces_among), self.tokenizer.model.tokenize, byte_characters()
        self.known = Generations(self._piece, CACHE)

    def _pieces_among(self, text: str, candidates: list[str]) -> set[str]:
        return {text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)}.intersection(candidates)

    def _piece(self, piece: str) -> bytes:
        """Straight to the library's merges, in the characters that stand for the piece's bytes there."""
        return array("I", [t.id for t in self.merges(piece.encode("utf-8", "replace").decode("latin-1").translate(self.stand_for))]).tobytes()

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        if self.by_piece and not any(token in text for token in self.added):
            return np.frombuffer(b"".join(map(self.known.__getitem__, self.pieces(text))), "<u4")
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=1)
def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """Read once a process."""
    return Encoder(path, special_as_text)


@dataclass(frozen=True)
class Packed:
    """Written files in order: path, documents, ids, and ids before it."""

    folder: str
    files: list[tuple[str, int, int, int]]


def write_packed(docs: DataFrame, tokenizer_path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, block: int = BLOCK, special_as_text: bool = False) -> Packed:
    """Encodes every whole text, appends end_id, and writes the ids in ascending id order; each task writes one range of ids as one file."""
    folder = folder or fresh_dir(docs.sparkSession, "packed")
    filesystem(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = filesystem(folder)
        encode = encoder(tokenizer_path, special_as_text)
        end, name, writer, first, out = np.array([end_id], "<u4"), f"{uuid.uuid4().hex}.glpk", None, None, None
        for batch in batches:
            ids, known, hashes, numbers, texts = batch.columns  # one text at a time leaves Arrow's memory
            for i in range(len(batch)):
                doc_id = ids[i].as_py() if known[i].as_py() else None
                if writer is None:
                    out = store.open_output_stream(f"{path}/{name}")
                    writer, first = Writer(out, bits_for(max(encode.vocabulary, end_id + 1)), block), (doc_id, hashes[i].as_py(), numbers[i].as_py())
                writer.add(doc_id, np.concatenate([encode(texts[i].as_py()), end]))
        if writer is not None:
            size = writer.close()
            out.close()
            row = {"name": name, "known": first[0] is not None, "id": first[0] or 0, "h": first[1], "k": first[2], "docs": len(writer.documents), "ids": writer.n, "bytes": size}
            yield pa.RecordBatch.from_pylist([row])

    h = F.xxhash64(F.col(text_col))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.col(id_col).isNotNull().alias("known"), h.alias("h"), F.monotonically_increasing_id().alias("k"), F.col(text_col).alias("text"))
    # The number lets rows that repeat id and text, which are alike, lie in more than one range.
    order = ["known", "id", "h", "k"]
    done = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, "name string, known boolean, id long, h long, k long, docs long, ids long, bytes long")
    files, before = [], 0
    for r in sorted(done.collect(), key=lambda r: (r["known"], r["id"], r["h"], r["k"])):  # one short row for each file
        files.append((r["name"], r["docs"], r["ids"], before))
        before += r["ids"]
    return Packed(folder, files)


def read_packed(spark: SparkSession, packed: Packed) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as read) of every document of the files, a task a file."""
    folder = packed.folder
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, intact boolean"

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = filesystem(folder)
        for frame in frames:
            for name, before in zip(frame["name"], frame["before"]):
                with store.open_input_file(f"{path}/{name}") as file:
                    reader = Reader(file)
                    d = reader.documents
                    for at in range(0, len(d), DOCS):
                        part = d[at : at + DOCS]
                        low = int(part["first"][0])
                        ids = reader.ids(low, int(part["first"][-1]) + int(part["n"][-1]))
                        crcs = [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip((part["first"].astype(np.int64) - low).tolist(), part["n"].tolist())]
                        whole = pd.array(part["id"].astype(np.int64), dtype="Int64")
                        whole[part["id"] == NULL_ID] = pd.NA
                        yield pd.DataFrame({"doc_id": whole, "start": part["first"].astype(np.int64) + before, "n_tokens": part["n"].astype(np.int64), "ids_crc32": crcs, "intact": np.array(crcs) == part["crc"]})

    files = spark.createDataFrame([(name, before) for name, _, _, before in packed.files], "name string, before long")
    return files.repartition(max(1, len(packed.files))).mapInPandas(read, schema)


def op7_packed_ids(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = write_packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_packed(spark, packed).select("doc_id", "start", "n_tokens", "ids_crc32")
