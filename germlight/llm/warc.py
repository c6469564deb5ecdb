"""WARC archives compressed record by record with a shared Zstandard dictionary.

Each file starts with a skippable frame that holds the dictionary; every record after it is a frame of its own, so any record can be read alone. The
dictionary is built from the archived records themselves (see `record_dictionary`) and only affects sizes, never contents. A warcinfo record leads them.

Of records with equal payloads of at least MIN_REVISIT bytes, that of the largest page_id is a response and the others are revisits, which hold no
payload. Payloads are compared by SHA-256; the SHA-1 goes into the record, as is usual there. A revisit names its response's URL and date, and its record id where one
record alone is that response; no two records have one id. The list of repeated payloads is broadcast up to BROADCAST_ROWS rows, counted first; beyond that it joins by
shuffle of the pages, where the planner splits hot payloads.

Tasks write files of unique names to the shared folder, and the driver gets one short row for each file of a task that succeeded: only those are read.

Defined cases: a null html is an empty payload; a null url is written as urn:page:<page_id>, and read back as null; a null page_id is left out of the record and is
revisited only by other null ones; rows that repeat the largest page_id with its payload are all responses; very long payloads are whole; an empty
table gives no file and an empty result; columns other than the named ones are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from germlight.llm._shared import bounded_broadcast, filesystem, fresh_dir, table

#: The magic number of the dictionary's frame, and the profile of a revisit of an equal payload.
DICTIONARY_MAGIC, ZSTD_MAGIC = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT, BROADCAST_ROWS = 1000, 100_000
#: The dictionary: its size, and how many records, and how much of each, it is built from.
DICTIONARY_BYTES, SAMPLE_RECORDS, SAMPLE_CHARS = 64 << 10, 512, 8192
LEVEL, CHUNK, ROWS = 3, 1 << 20, 256
DATE = "2026-01-01T00:00:00Z"


def record_id(page_id: int | None = None, sha1: bytes | None = None) -> str:
    """The id of the one response of a page id and payload, which revisits can compute; without these an id that no other record has."""
    return f"<urn:uuid:{uuid.uuid4() if sha1 is None else uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{sha1.hex()}')}>"


def target(page_id: int | None, url: str | None) -> str:
    return quote(url, safe=_URL) if url is not None else f"urn:page:{page_id}"


def info(date: str = DATE) -> bytes:
    """The record that describes a file."""
    block = b"software: germlight\r\nformat: WARC File Format 1.1\r\n"
    return "\r\n".join(["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id()}", f"WARC-Date: {date}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, revisit: bool = False, size: int | None = None, sha1: bytes | None = None, own: str | None = None, refers: tuple[int | None, str | None, str | None] | None = None, date: str = DATE) -> bytes:
    """One whole record. A revisit keeps the HTTP head, the digest and the size of the payload, not the payload; refers is its response's (page id, url, record id or none)."""
    digest = base64.b32encode(sha1 or hashlib.sha1(payload).digest()).decode()
    size = len(payload) if size is None else size
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {own or record_id()}", f"WARC-Date: {date}"]
    head += [f"WARC-Target-URI: {target(page_id, url)}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    head += [f"X-Url-Missing: {int(url is None)}"] + ([] if page_id is None else [f"X-Page-Id: {page_id}"])
    if revisit and refers is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To-Target-URI: {target(*refers[:2])}", f"WARC-Refers-To-Date: {date}"]
        head += ([] if refers[2] is None else [f"WARC-Refers-To: {refers[2]}"]) + ([] if refers[0] is None else [f"X-Refers-To-Page-Id: {refers[0]}"])
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


#: Characters of a URL that are written as they are; others, line ends among them, are percent-encoded.
_URL = "!#$&'()*+,/:;=?@[]~%-._"


def record_dictionary(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> bytes:
    """A dictionary from records of about SAMPLE_RECORDS pages, those whose payload has the least hash, up to SAMPLE_CHARS characters each; empty if there are too few."""
    import zstandard

    h = F.xxhash64(html_col)
    rows = pages.where(F.col(html_col) != "").select(F.col(url_col).alias("url"), F.substring(html_col, 1, SAMPLE_CHARS).alias("html"), h.alias("h"))
    # Hashes below this are about SAMPLE_RECORDS of the rows; copies share one, and one of them is enough. So few rows leave their tasks.
    limit = min(-(2**63) + 2**64 * SAMPLE_RECORDS // max(1, pages.count()), 2**63 - 1)
    chosen = rows.where(F.col("h") <= limit).groupBy("h").agg(F.min(F.struct("url", "html")).alias("r")).orderBy("h").limit(2 * SAMPLE_RECORDS)
    sample = [record(i, r["url"], r["html"].encode("utf-8", "replace")) for i, r in enumerate(chosen.select("r.*").collect())]
    if len(sample) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, sample)) // 10)), sample, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little to learn from; a file without that frame is as valid
        return b""


def roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """The rows as they are, with payload_bytes, sha1 (binary), revisit, and of the response refers_to, refers_url and refers_one: whether one row alone is that response."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    size = F.octet_length(payload).cast("long")
    key = F.unhex(F.sha2(payload, 256))
    each = pages.where(size >= min_bytes).groupBy(key.alias("key"), F.col(id_col).alias("_id")).agg(F.count("*").alias("_n"), F.max(url_col).alias("_url"))
    last = F.max(F.struct("_id", "_n", "_url")).alias("_last")
    repeated = each.groupBy("key").agg(last, F.sum("_n").alias("_rows")).where("_rows > 1").select("key", F.col("_last._id").alias("_first"), (F.col("_last._n") == 1).alias("_one"), F.col("_last._url").alias("_url"), F.lit(True).alias("_again"))
    # Payloads that are never revisited have a key that joins nothing: were it null, one task would get them all.
    own = F.when(size >= min_bytes, key).otherwise(F.unhex(F.hex(F.xxhash64(id_col, url_col, html_col))))
    rows = pages.withColumns({"payload_bytes": size, "sha1": F.unhex(F.sha1(payload)), "key": own})
    rows = rows.join(bounded_broadcast(repeated, BROADCAST_ROWS), "key", "left").drop("key")
    revisit = F.coalesce(F.col("_again") & ~F.col(id_col).eqNullSafe(F.col("_first")), F.lit(False))
    of_response = {"refers_to": F.col("_first"), "refers_url": F.col("_url"), "refers_one": F.coalesce("_one", F.lit(False))}
    return rows.withColumns({"revisit": revisit, **of_response}).drop("_first", "_again", "_one", "_url")


@dataclass(frozen=True)
class Archive:
    folder: str
    files: list[str]


def write_warc(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_REVISIT) -> Archive:
    """Writes a record for every row, a file a task."""
    import zstandard

    folder = folder or fresh_dir(pages.sparkSession, "warc")
    filesystem(folder)
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    dictionary = record_dictionary(own)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = filesystem(folder)
        name, out, n = f"{uuid.uuid4().hex}.warc.zst", None, 0
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_content_size=True, write_checksum=True).compress
        for frame in frames:
            if out is None and len(frame):
                out = store.open_output_stream(f"{path}/{name}")
                if dictionary:
                    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                out.write(compress(info()))
            for known, page_id, url, html, size, sha1, revisit, again, refers_to, refers_url, one in frame.itertuples(index=False):
                page_id, refers_to = page_id if known else None, refers_to if again else None
                the_one = record_id(refers_to, sha1) if one else None
                out.write(compress(record(page_id, url, (html or "").encode("utf-8", "replace"), revisit, size, sha1, None if revisit else the_one, (refers_to, refers_url, the_one) if revisit else None)))
                n += 1
        if out is not None:
            out.close()
            yield pd.DataFrame({"name": [name], "records": [n]})

    rows = roles(own, min_bytes=min_bytes)
    whole = lambda c: F.coalesce(F.col(c), F.lit(0))  # noqa: E731  pandas would turn nullable longs into doubles
    rows = rows.select(F.col("page_id").isNotNull(), whole("page_id").alias("page_id"), "url", F.when(~F.col("revisit"), F.col("html")).alias("html"), "payload_bytes", "sha1", "revisit", F.col("refers_to").isNotNull().alias("again"), whole("refers_to").alias("refers_to"), "refers_url", "refers_one")
    return Archive(folder, sorted(r["name"] for r in rows.mapInPandas(write, "name string, records long").collect()))  # one short row for each file


def records(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of a binary stream; holds one record and one chunk."""
    import zstandard

    data, dictionary = file.read(CHUNK), None
    while len(data) >= 8 or (data := data + file.read(CHUNK)):
        magic, size = struct.unpack("<II", data[:8])
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            while len(data) < 8 + size:
                if not (more := file.read(CHUNK)):
                    raise ValueError("the file ends within a frame")
                data += more
            if magic == DICTIONARY_MAGIC:
                content = data[8 : 8 + size]
                dictionary = zstandard.ZstdCompressionDict(zstandard.decompress(content) if content[:4] == ZSTD_MAGIC else content)
            data = data[8 + size :]
        else:
            frame, parts = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj(), []
            while not frame.eof:
                if not data and not (data := file.read(CHUNK)):
                    raise ValueError("the file ends within a record")
                parts.append(frame.decompress(data))
                data = b""
            data = frame.unused_data
            head, _, block = b"".join(parts).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("not a WARC record")
            fields = dict(x.split(": ", 1) for x in lines[1:])
            yield fields, block[: int(fields["Content-Length"])]
        if not data:
            data = file.read(CHUNK)


def read_warc(spark: SparkSession, archive: Archive, payloads: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, intact, and the payload if asked for, of every record; a task a file.

    A response's size and digest are computed from its payload as read; intact says whether they equal what its fields say.
    """
    folder = archive.folder
    columns = {"page_id": "Int64", "url": object, "payload_bytes": "int64", "payload_digest": object, "record_type": object, "refers_to": "Int64", "intact": bool, **({"payload": object} if payloads else {})}

    def row(fields: dict[str, str], block: bytes) -> tuple:
        number = lambda k: int(fields[k]) if k in fields else pd.NA
        said, size, payload = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex(), int(fields["X-Payload-Length"]), None
        digest, n = said, size
        if fields["WARC-Type"] == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            digest, n = hashlib.sha1(payload).hexdigest(), len(payload)
        url = None if fields["X-Url-Missing"] == "1" else fields["WARC-Target-URI"]
        return (number("X-Page-Id"), url, n, digest, fields["WARC-Type"], number("X-Refers-To-Page-Id"), (digest, n) == (said, size), *([payload] if payloads else []))

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({c: pd.Series([r[i] for r in rows], dtype=kind) for i, (c, kind) in enumerate(columns.items())})

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = filesystem(folder)
        for names in frames:
            for name in names["name"]:
                rows = []
                with store.open_input_stream(f"{path}/{name}") as file:
                    for fields, block in records(file):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(row(fields, block))
                        if len(rows) == ROWS:
                            yield frame(rows)
                            rows = []
                yield frame(rows)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean" + ", payload binary" * payloads
    files = spark.createDataFrame([(name,) for name in archive.files], "name string")
    return files.repartition(max(1, len(archive.files))).mapInPandas(read, schema)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    archive = write_warc(table(spark, sf_dir, "pages"))
    return read_warc(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest, CASE WHEN n >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (h)
"""
