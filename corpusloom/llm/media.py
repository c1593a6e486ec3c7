"""Media columns: signature sniffing over binary columns.

An Aho-Corasick automaton finds magic bytes anywhere in a value; a validator per format then confirms structure and
lengths, so text that merely contains ``BM`` or ``GIF89a`` isn't media. A confirmed format at offset 0 that spans the
value corrects the declared type; confirmed formats further in are carved out. ``store`` writes payloads as 8-bit samples
of one of three formats, sound or picture, under a declared type that is often wrong, both chosen by the payload's
checksum; ``probe`` reads values back through the sniffer alone, which isn't told either.

Defined cases: a null text is the empty payload (one padding unit); a null or unrecognised value keeps its declared
type with no payload; truncated or corrupt structures aren't confirmed; equal values give equal results; a very long
text is one value, held at once; an empty table gives no rows; ``store`` drops other columns, ``carve`` and ``probe`` keep
them but for those of their own names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import prepare, with_columns

UNIT = 576
RATE = 8000


@dataclass(frozen=True)
class Found:
    """A confirmed format: where it lies, and where its sample data lie."""

    kind: str
    start: int
    end: int
    data: tuple[int, int]
    detail: str = ""


def _u16(b, i):
    return int.from_bytes(b[i : i + 2], "little")


def _u32(b, i):
    return int.from_bytes(b[i : i + 4], "little")


def _wav(b: bytes, at: int) -> Found | None:
    end = at + 8 + _u32(b, at + 4)
    if end > len(b) or b[at + 8 : at + 12] != b"WAVE":
        return None
    i, form, data = at + 12, None, None
    while i + 8 <= end:
        size, body = _u32(b, i + 4), i + 8
        if body + size > end:
            return None
        if b[i : i + 4] == b"fmt " and size >= 16:
            form = struct.unpack("<HHIIHH", b[body : body + 16])
        elif b[i : i + 4] == b"data":
            data = (body, body + size)
        i = body + size + size % 2
    if i != end or form is None or data is None:
        return None
    tag, channels, rate, per_s, block, bits = form
    if tag != 1 or not channels or block != channels * bits // 8 or per_s != rate * block or (data[1] - data[0]) % block:
        return None
    return Found("audio/wav", at, end, data, f"{channels}x{bits}@{rate}:{(data[1] - data[0]) // block}")


def _png(b: bytes, at: int) -> Found | None:
    i, first, shape = at + 8, True, ""
    while i + 12 <= len(b):
        size, kind = int.from_bytes(b[i : i + 4], "big"), b[i + 4 : i + 8]
        if i + 12 + size > len(b) or zlib.crc32(b[i + 4 : i + 8 + size]) != int.from_bytes(b[i + 8 + size : i + 12 + size], "big"):
            return None
        if first:
            if kind != b"IHDR" or size != 13:
                return None
            w, h = struct.unpack(">II", b[i + 8 : i + 16])
            shape, first = f"{w}x{h}", False
        i += 12 + size
        if kind == b"IEND":
            return Found("image/png", at, i, (at, i), shape)
    return None


def _gif(b: bytes, at: int) -> Found | None:
    def blocks(i: int) -> int | None:
        while i < len(b):
            if not b[i]:
                return i + 1
            i += 1 + b[i]
        return None

    if at + 13 > len(b):
        return None
    w, h, flags = _u16(b, at + 6), _u16(b, at + 8), b[at + 10]
    i: int | None = at + 13 + (3 << (flags % 8 + 1) if flags & 128 else 0)
    if not w or not h:
        return None
    while i is not None and i < len(b):
        if b[i] == 0x3B:
            return Found("image/gif", at, i + 1, (at, i + 1), f"{w}x{h}")
        if b[i] == 0x21:
            i = blocks(i + 2)
        elif b[i] == 0x2C and i + 11 <= len(b):
            i = blocks(i + 11 + (3 << (b[i + 9] % 8 + 1) if b[i + 9] & 128 else 0))
        else:
            return None
    return None


def _jpeg(b: bytes, at: int) -> Found | None:
    i, shape = at + 2, ""
    while i + 4 <= len(b):
        if b[i] != 0xFF:
            return None
        mark = b[i + 1]
        size = int.from_bytes(b[i + 2 : i + 4], "big")
        if size < 2 or mark in (0x00, 0xFF):
            return None
        if 0xC0 <= mark <= 0xC3 and i + 9 <= len(b):
            h, w = struct.unpack(">HH", b[i + 5 : i + 9])
            shape = f"{w}x{h}"
        i += 2 + size
        if mark == 0xDA:
            end = b.find(b"\xff\xd9", i)
            return Found("image/jpeg", at, end + 2, (at, end + 2), shape) if end >= 0 and shape else None
    return None


def _bmp(b: bytes, at: int) -> Found | None:
    if at + 30 > len(b):
        return None
    size, reserved, offset, head = _u32(b, at + 2), _u32(b, at + 6), _u32(b, at + 10), _u32(b, at + 14)
    if reserved or head not in (12, 40, 52, 56, 64, 108, 124) or not 14 + head <= offset <= size or at + size > len(b):
        return None
    planes, bits = (_u16(b, at + 22), _u16(b, at + 24)) if head == 12 else (_u16(b, at + 26), _u16(b, at + 28))
    if planes != 1 or bits not in (1, 4, 8, 16, 24, 32):
        return None
    return Found("image/bmp", at, at + size, (at + offset, at + size), f"{bits}bit")


def _pnm(b: bytes, at: int) -> Found | None:
    numbers, i = [], at + 2
    while len(numbers) < 3:
        while i < len(b) and b[i] in b" \t\n\r":
            i += 1
        k = i
        while i < len(b) and i - k < 10 and 48 <= b[i] <= 57:
            i += 1
        if i == k or i >= len(b):
            return None
        numbers.append(int(b[k:i]))
    w, h, most = numbers
    if b[i] not in b" \t\n\r" or not w or not h or not 0 < most < 65536:
        return None
    end = i + 1 + w * h * (3 if b[at + 1] == 54 else 1) * (2 if most > 255 else 1)
    return Found("image/x-portable-anymap", at, end, (i + 1, end), f"{w}x{h}") if end <= len(b) else None


def _gzip(b: bytes, at: int) -> Found | None:
    d, i = zlib.decompressobj(31), at
    try:
        while i < len(b) and not d.eof:  # in pieces, so that a bomb isn't unpacked at once
            chunk = d.unconsumed_tail or b[i : i + 65536]
            i += 0 if d.unconsumed_tail else len(chunk)
            d.decompress(chunk, 1 << 20)
    except zlib.error:
        return None
    return Found("application/gzip", at, i - len(d.unused_data), (at, i - len(d.unused_data))) if d.eof else None


def _pdf(b: bytes, at: int) -> Found | None:
    end = b.find(b"%%EOF", at)
    if not b[at + 5 : at + 6].isdigit() or end < 0 or b.find(b"startxref", at, end) < 0:
        return None
    return Found("application/pdf", at, end + 5, (at, end + 5), b[at + 5 : at + 8].decode("latin-1"))


#: Magic bytes and what confirms them.
FORMATS: tuple[tuple[bytes, Callable[[bytes, int], Found | None]], ...] = (
    (b"RIFF", _wav), (b"\x89PNG\r\n\x1a\n", _png), (b"GIF87a", _gif), (b"GIF89a", _gif), (b"\xff\xd8\xff", _jpeg),
    (b"BM", _bmp), (b"P5", _pnm), (b"P6", _pnm), (b"\x1f\x8b\x08", _gzip), (b"%PDF-", _pdf),
)


class Sniffer:
    def __init__(self, formats=FORMATS) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for magic, check in formats:
            self.automaton.add_word(magic.decode("latin-1"), (len(magic), check))
        self.automaton.make_automaton()

    def find(self, value: bytes | None) -> list[Found]:
        """Confirmed formats by offset; what lies inside an earlier one's structure (not in its samples) is part of it."""
        if not value:
            return []
        out, sure = [], -1
        for last, (length, check) in self.automaton.iter(value.decode("latin-1")):
            at = last - length + 1
            if at >= sure and (got := check(value, at)):
                out.append(got)
                sure = got.data[0]
        return sorted(out, key=lambda f: (f.start, -f.end))

    def kind(self, value: bytes | None, declared: str | None) -> tuple[str | None, Found | None, list[Found]]:
        """The corrected type, the format that spans the value if one does, and the media embedded in it."""
        found = self.find(value)
        whole = next((f for f in found if f.start == 0 and f.end == len(value)), None)
        return (whole.kind if whole else declared), whole, [f for f in found if f is not whole]


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """8-bit mono PCM with the payload as its samples."""
    form = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, rate, rate, 1, 8)
    pad = b"\0" * (len(payload) % 2)
    body = b"WAVE" + form + struct.pack("<4sI", b"data", len(payload)) + payload + pad
    return struct.pack("<4sI", b"RIFF", len(body)) + body


def to_pgm(payload: bytes, unit: int = UNIT) -> bytes:
    """A grey picture, ``unit`` pixels wide."""
    return b"P5\n%d %d\n255\n" % (unit, len(payload) // unit) + payload


def to_bmp(payload: bytes, unit: int = UNIT) -> bytes:
    """A picture of 256 greys, ``unit`` pixels wide, rows from the top."""
    offset = 14 + 40 + 1024
    head = struct.pack("<2sIII", b"BM", offset + len(payload), 0, offset)
    form = struct.pack("<IiiHHIIiiII", 40, unit, -(len(payload) // unit), 1, 8, 0, len(payload), 2835, 2835, 256, 0)
    return head + form + b"".join(bytes((i, i, i, 0)) for i in range(256)) + payload


#: Ways to store a payload, and the types that a value may be declared as.
CONTAINERS = (to_wav, to_pgm, to_bmp)
DECLARED = ("audio/wav", "image/x-portable-anymap", "image/bmp", "application/octet-stream", "text/plain")


def padded(raw: bytes, unit: int = UNIT) -> bytes:
    return raw + b"\xff" * (max(1, -(-len(raw) // unit)) * unit - len(raw))


def store(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", unit: int = UNIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``declared`` and the ``media`` value of each text. A payload's checksum picks its container
    and, independently, the type it is declared as."""

    def make():
        def step(cols):
            raw = [t.encode() if t else b"" for t in cols["text"]]
            payloads = [padded(x, unit) for x in raw]
            sums = [zlib.crc32(x) for x in payloads]
            return {"n_bytes": list(map(len, raw)), "declared": [DECLARED[(k >> 8) % len(DECLARED)] for k in sums],
                    "media": [CONTAINERS[k % len(CONTAINERS)](x) for k, x in zip(sums, payloads, strict=True)]}

        return step

    prepare(df.sparkSession)
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    fields = [("n_bytes", "bigint"), ("declared", "string"), ("media", "binary")]
    return with_columns(docs, ["text"], make, fields).drop("text")


def carve(df: DataFrame, media_col: str = "media", declared_col: str = "declared") -> DataFrame:
    """``df`` with ``media_type`` (corrected), ``payload`` (samples of the spanning format) and embedded media as lists
    ``found_start`` and ``found_end``, ``found_type``."""

    def make():
        s = Sniffer()

        def step(cols):
            got = [s.kind(v, d) for v, d in zip(cols[media_col], cols[declared_col], strict=True)]
            return {
                "media_type": [k for k, _, _ in got],
                "payload": [v[slice(*w.data)] if w else None for v, (_, w, _) in zip(cols[media_col], got, strict=True)],
                "found_start": [[f.start for f in e] for _, _, e in got],
                "found_end": [[f.end for f in e] for _, _, e in got],
                "found_type": ["|".join(f.kind for f in e) for _, _, e in got],
            }

        return step

    fields = [("media_type", "string"), ("payload", "binary"), ("found_start", "array<bigint>"),
              ("found_end", "array<bigint>"), ("found_type", "string")]
    return with_columns(df, [media_col, declared_col], make, fields)


def probe(df: DataFrame, media_col: str = "media", declared_col: str = "declared") -> DataFrame:
    """``df`` without its media, with the digests of what the sniffer reads back and a ``feature`` string."""

    def make():
        s = Sniffer()

        def step(cols):
            out: dict[str, list] = {n: [] for n, _ in fields}
            for value, declared in zip(cols[media_col], cols[declared_col], strict=True):
                kind, whole, inside = s.kind(value, declared)
                data = value[slice(*whole.data)] if whole else b""
                out["payload_bytes"].append(len(data))
                out["payload_sha256"].append(hashlib.sha256(data).hexdigest())
                out["tail_crc32"].append(zlib.crc32(data[-32:]))
                out["media_bytes"].append(len(value or b""))
                out["media_sha256"].append(hashlib.sha256(value or b"").hexdigest())
                carved = ",".join(f"{f.kind}@{f.start}+{f.end - f.start}" for f in inside)
                out["feature"].append(f"{declared}>{kind};{whole.detail if whole else ''};[{carved}]")
            return out

        return step

    fields = [("payload_bytes", "bigint"), ("payload_sha256", "string"), ("tail_crc32", "bigint"),
              ("media_bytes", "bigint"), ("media_sha256", "string"), ("feature", "string")]
    return with_columns(df, [media_col, declared_col], make, fields).drop(media_col, declared_col)
