"""Byte-level BPE by dynamic programming over prefixes.

The BPE encoding of a prefix of a piece ends in exactly one token, and cutting that token off leaves the encoding of the shorter prefix. So one number for
each byte, the last token of the prefix that ends there, holds the encodings of all prefixes: a token t that is a suffix of the prefix is the right one if
it and the last token of what precedes it stay apart when their bytes are encoded together. Appending bytes extends the list and changes
nothing before; an edit recomputes from its first byte until the list runs as before over the length of the longest token (`Prefixes`).

Texts are split into pieces by the vocabulary's pattern first, with letters and numbers as the library has them (`characters`). A worker keeps the ids of pieces it has met, as many as its memo holds.

Defined cases: a null or empty text has no ids and decodes to no bytes; repeated rows are each encoded; texts of any length are whole; an empty
table gives an empty result; a null doc_id passes through; columns other than the named ones are ignored; bytes that no token covers (an incomplete
vocabulary) raise ValueError.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from germlight.llm._shared import Generations, release_memory, table
from germlight.llm.characters import Splitter

#: Entries of a worker's memos of pieces, token pairs and prefixes: about 150 MB for the first setting, 30 MB for the second, which encodes more anew.
MEMO, SMALL_MEMO = (800_000, 300_000, 300_000), (150_000, 60_000, 60_000)
NEVER = 1 << 62


def library_pieces(pattern: str, text: str, candidates: list[str]) -> set[str]:
    """Which candidates are whole pieces of text as tiktoken splits it: with each one a token that no merge leads to, only those come out as tokens."""
    from tiktoken import Encoding

    ranks = {bytes([b]): b for b in range(256)} | {c.encode(): 256 + i for i, c in enumerate(candidates)}
    return {candidates[i - 256] for i in set(Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text)) if i >= 256}


class Vocabulary:
    """Tokens by rank, and what the dynamic programming asks of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: tuple[int, int, int] = MEMO):
        self.memo = memo
        self.ranks, self.pieces_of = ranks, Splitter(pattern, partial(library_pieces, pattern))
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        # Endings of tokens with their rank, or -1 where they are none: past bytes that end no token, longer ones end none either.
        self.endings = dict.fromkeys((token[i:] for token in ranks for i in range(len(token))), -1) | ranks
        self._names = {rank: str(rank) for rank in self.tokens}
        self.forget()

    def forget(self) -> None:
        """Drops what encoding has gathered; the vocabulary itself stays."""
        self._known = Generations(self.encode_piece, self.memo[0])
        self._apart: dict[int, bool] = {}
        self._courses: dict[int, tuple[list[tuple[int, bytes, bytes]], bool]] = {}
        self._plant()
        release_memory()

    def _plant(self) -> None:
        """Prefixes of all pieces in one tree: node * 256 + byte -> node; each node has its prefix's last token and the node before that token."""
        self._next: dict[int, int] = {}
        self._last, self._before = [-1], [-1]

    def merged(self, data: bytes) -> list[int]:
        """Encoding by the definition: join the adjacent pair of least rank, leftmost first, while there is one."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def course(self, t: int) -> tuple[list[tuple[int, bytes, bytes]], bool]:
        """The joins that make token t of its bytes: (rank, first part after it, last part after it) of each, and whether t comes out whole."""
        if (known := self._courses.get(t)) is None:
            data, steps = self.tokens[t], []
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 1:
                rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
                if rank == NEVER:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                steps.append((rank, parts[0], parts[-1]))
            known = self._courses[t] = (steps, len(parts) == 1)
        return known

    def whole(self, t: int) -> bool:
        """Whether token t is the encoding of its bytes."""
        return self.course(t)[1]

    def apart(self, a: int, b: int) -> bool:
        """Whether tokens a and b, side by side, are the encoding of their bytes.

        Until a join crosses the border, each side goes its own course, the least rank first and the left one of equals. So it is enough to follow both
        courses at once and to ask, of the parts that meet at the border, whether their join is due before the next one on either side.
        """
        if (known := self._apart.get(a << 32 | b)) is not None:
            return known
        (left, whole_a), (right, whole_b) = self.course(a), self.course(b)
        known = whole_a and whole_b
        i = j = 0
        x, y = self.tokens[a][-1:], self.tokens[b][:1]
        while known:
            due_a, due_b = left[i][0] if i < len(left) else NEVER, right[j][0] if j < len(right) else NEVER
            crossing = self.ranks.get(x + y, NEVER)
            if crossing < due_a and crossing <= due_b:
                known = False
            elif due_a <= due_b:
                if due_a == NEVER:
                    break
                x, i = left[i][2], i + 1
            else:
                y, j = right[j][1], j + 1
        if len(self._apart) >= self.memo[1]:
            self._apart.clear()
        self._apart[a << 32 | b] = known
        return known

    def suffixes(self, data: bytes, end: int) -> list[tuple[int, int]]:
        """(start, token) of the tokens that end data[:end], the longest first."""
        endings, found = self.endings, []
        for start in range(end - 1, -1, -1):
            rank = endings.get(data[start:end])
            if rank is None:
                break
            if rank >= 0:
                found.append((start, rank))
        found.reverse()
        return found

    def last_token(self, data: bytes, end: int, last: list[int]) -> int:
        """The last token of data[:end], given those of all shorter prefixes."""
        for start, t in self.suffixes(data, end):
            if self.apart(last[start - 1], t) if start else self.whole(t):
                return t
        raise ValueError(f"no token of the vocabulary ends prefix {data[:end]!r}")

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Appends the last tokens of the prefixes of data that are longer than last."""
        for end in range(len(last) + 1, len(data) + 1):
            last.append(self.last_token(data, end, last))
        return last

    def back(self, last: list[int]) -> list[int]:
        """The whole encoding, read off the list from its end."""
        ids, at = [], len(last)
        while at:
            ids.append(last[at - 1])
            at -= len(self.tokens[last[at - 1]])
        return ids[::-1]

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Walks the tree of prefixes that pieces share, and grows it where this one is new."""
        data = piece.encode("utf-8", "replace")
        rank = self.ranks.get(data)
        if rank is not None and self.whole(rank):
            return (rank,)
        if len(self._last) >= self.memo[2]:
            self._plant()
        step, last, before, node, path = self._next, self._last, self._before, 0, [0]
        for end, byte in enumerate(data, 1):
            key = node << 8 | byte
            node = step.get(key)
            if node is None:
                for start, t in self.suffixes(data, end):
                    if self.apart(last[path[start]], t) if start else self.whole(t):
                        break
                else:
                    raise ValueError(f"no token of the vocabulary ends prefix {data[:end]!r}")
                node = step[key] = len(last)
                last.append(t), before.append(path[start])
            path.append(node)
        ids = []
        while node:
            ids.append(last[node])
            node = before[node]
        return tuple(reversed(ids))

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self._known.__getitem__, self.pieces_of(text or ""))))

    def decimal(self, ids: Iterable[int]) -> str:
        return " ".join(map(self._names.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Prefixes:
    """One piece, with the last token of each of its prefixes; edits keep it exact."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.v.extend(self.data, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Puts new for bytes start ... stop - 1; returns how many prefixes were computed."""
        tail, data = self.last[stop:], self.data[:start] + new + self.data[stop:]
        last, resumed = self.last[:start], start + len(new)
        same = done = 0
        while len(last) < len(data):
            # As many equal neighbours as the longest token: what follows can't see the edit any more.
            if same >= self.v.longest:
                last += tail[len(last) - resumed :]
                break
            t = self.v.last_token(data, len(last) + 1, last)
            at = len(last) - resumed
            same = same + 1 if at >= 0 and tail[at] == t else 0
            last.append(t)
            done += 1
        self.data, self.last = data, last
        return done

    def ids(self, length: int | None = None) -> list[int]:
        """The encoding of the piece, or of its prefix of that many bytes."""
        return self.v.back(self.last if length is None else self.last[:length])


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str, memo: tuple[int, int, int] = MEMO) -> Vocabulary:
    """Read from a rank file (a base64 token and its rank on each line) once a process."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}, pattern, memo)


def _with_vocabulary(each: Callable[[Vocabulary, pa.Array], pa.Array], schema: str, path: str, pattern: str):
    """An Arrow UDF over each task's batches; what the task has learnt is forgotten at its end, so that idle workers stay small."""

    @F.arrow_udf(schema)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocabulary(path, pattern)
        try:
            for batch in batches:
                yield each(v, batch)
        finally:
            v.forget()

    return run


def encoded(text: Column, path: str, pattern: str) -> Column:
    """ids array<int> of the whole text."""
    return _with_vocabulary(lambda v, texts: pa.array([v.encode(t.as_py()) for t in texts], pa.list_(pa.int32())), "array<int>", path, pattern)(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of ids."""
    return _with_vocabulary(lambda v, lists: pa.array([v.decode(x.as_py()) for x in lists], pa.binary()), "binary", path, pattern)(ids)


def encode_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", memo: tuple[int, int, int] = MEMO) -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of every row: encodes, then decodes the ids, and keeps digests only, so that no long array leaves the worker.
    A narrow plan; one text at a time leaves Arrow's memory."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, sha = vocabulary(path, pattern, memo), hashlib.sha256
        try:
            for batch in batches:
                keys, texts = batch.columns
                rows: tuple[list, list, list] = ([], [], [])
                for text in texts:
                    ids = v.encode(text.as_py())
                    rows[0].append(len(ids)), rows[1].append(sha(v.decimal(ids).encode()).hexdigest()), rows[2].append(sha(v.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([keys, pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            v.forget()

    own = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return own.mapInArrow(each, f"`{id_col}` {own.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_prefix_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
