"""A BAM encoder for tests, from the public format: BGZF blocks are gzip members with their size in an extra field."""

import struct
import zlib

CODES = "=ACMGRSVTWYHKDBN"
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def bgzf(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def tag(name: str, value) -> bytes:
    if isinstance(value, tuple):  # (type, value)
        kind, v = value
        if kind == "B":
            sub, numbers = v
            return name.encode() + b"B" + sub.encode() + struct.pack(f"<i{len(numbers)}{ {'c': 'b', 'C': 'B', 's': 'h', 'S': 'H', 'i': 'i', 'I': 'I', 'f': 'f'}[sub]}", len(numbers), *numbers)
        return name.encode() + kind.encode() + (v.encode() if kind == "A" else struct.pack({"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}[kind], v))
    return name.encode() + b"Z" + value.encode() + b"\0"


def record(name, flag=0, ref=0, pos=0, mapq=60, cigar=(), sequence="", quality=None, tags=None) -> bytes:
    n = len(sequence)
    nibbles = [CODES.index(b) for b in sequence] + [0] * (n % 2)
    packed = bytes(a << 4 | b for a, b in zip(nibbles[::2], nibbles[1::2]))
    phred = b"\xff" * n if quality is None else bytes(ord(q) - 33 for q in quality)
    head = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, 4680, len(cigar), flag, n, -1, -1, 0)
    body = head + name.encode() + b"\0" + struct.pack(f"<{len(cigar)}I", *(length << 4 | "MIDNSHP=X".index(op) for length, op in cigar)) + packed + phred + b"".join(tag(k, v) for k, v in (tags or {}).items())
    return struct.pack("<i", len(body)) + body


def write_bam(path, references, records, block=4000) -> None:
    text = b"@HD\tVN:1.6\tSO:unsorted\n"
    head = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(references))
    for name, length in references:
        head += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", length)
    data = head + b"".join(records)
    with open(path, "wb") as out:
        for at in range(0, len(data), block):
            out.write(bgzf(data[at : at + block]))
        out.write(END)
