"""Media columns: signature sniffing, structural validation, correction of declared types, carving.

One Aho-Corasick automaton holds the magic bytes of all formats.  Each hit in a
value is a place where a format may begin; the format's validator then reads
the header, lengths and checksums there and says how long the object is, or
that there is none.  An object at the start that takes the whole value gives
its true type, whatever type was declared; objects further in are carved with
their offsets.  A hit inside an object that was accepted is part of it and is
reported as embedded.

Payloads are stored as 8-bit samples in one of three containers (chosen by the
payload's digest, so equal texts have equal values): WAVE, bitmap, PNG.

Walks over blocks and chunks keep their ends for each value, so many hits in a
long value take a time near its length.

Null texts are empty.  Values with no known signature have the type
``application/octet-stream``; truncated or damaged objects are not accepted.
Repeated rows and rows without an id give a row each, equal texts equal values;
objects at one place come with the longest first; empty tables give no rows;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import map_rows, table

UNIT, TAIL = 192, 16
UNKNOWN = "application/octet-stream"


@dataclass(frozen=True)
class Found:
    kind: str
    offset: int
    size: int


class Value:
    """Bytes with the places of closing marks and the ends of walks, found once however many objects ask for them."""

    def __init__(self, data: bytes):
        self.data, self.view, self._places = data, memoryview(data), {}
        self._ends: dict[str, dict[int, int]] = {}
        self._jumps: dict[tuple[int, int], tuple[int, int] | None] = {}

    def end(self, walk: str, at: int, step: Callable[[int], tuple[int, bool]]) -> int:
        """Where the walk from ``at`` ends (-1: nowhere).  ``step`` gives the next place and whether it is the end.

        All places of a walk keep its end, so walks that meet are gone once.
        """
        ends, way = self._ends.setdefault(walk, {}), []
        while at not in ends:
            way.append(at)
            at, last = step(at)
            if last:
                ends[way[-1]] = at
                at = way[-1]
        found = ends[at]
        for p in way:
            ends[p] = found
        return found

    def _jump(self, at: int, level: int, step: Callable[[int], tuple[int, int] | None]) -> tuple[int, int] | None:
        """Sixteen to the power of ``level`` steps at once: (place, marks seen)."""
        if (at, level) not in self._jumps:
            made: tuple[int, int] | None = (at, 0)
            if level == 0:
                made = step(at)
            for _ in range(16 if level else 0):
                more = self._jump(made[0], level - 1, step)
                made = more and (more[0], made[1] | more[1])
                if made is None:
                    break
            self._jumps[at, level] = made
        return self._jumps[at, level]

    def marks(self, at: int, end: int, step: Callable[[int], tuple[int, int] | None]) -> int | None:
        """Marks of the steps from ``at`` to exactly ``end``; None if they do not meet it.  Few jumps do for many steps."""
        seen, level, taken = 0, 0, 0
        while at < end:
            made = self._jump(at, level, step)
            if made and made[0] <= end:
                at, seen, taken = made[0], seen | made[1], taken + 1
                if taken == 16:
                    level, taken = level + 1, 0
            elif level:
                level, taken = level - 1, 0
            else:
                return None
        return seen if at == end else None

    def places(self, mark: bytes) -> list[int]:
        if mark not in self._places:
            self._places[mark] = [m.start() for m in re.finditer(re.escape(mark), self.data)]
        return self._places[mark]

    def after(self, mark: bytes, at: int) -> int:
        found = self.places(mark)
        k = bisect_left(found, at)
        return found[k] if k < len(found) else -1


def check_wav(v: Value, at: int) -> int:
    """Bytes of a RIFF/WAVE file with a format and a data chunk, or 0."""
    b = v.view
    if len(b) - at < 44 or bytes(b[at + 8 : at + 12]) != b"WAVE":
        return 0
    size = 8 + struct.unpack_from("<I", b, at + 4)[0]
    if at + size > len(b):
        return 0

    def step(p: int) -> tuple[int, int] | None:
        """The next chunk, and 1 for a format, 2 for data, 4 for a format that is too short."""
        if p + 8 > len(b):
            return None
        name, n = bytes(b[p : p + 4]), struct.unpack_from("<I", b, p + 4)[0]
        mark = (4 if n < 16 else 1) if name == b"fmt " else 2 if name == b"data" else 0
        return (p + 8 + n + (n & 1), mark) if p + 8 + n <= len(b) else None

    return size if v.marks(at + 12, at + size, step) == 3 else 0


def check_bmp(v: Value, at: int) -> int:
    b = v.view
    if len(b) - at < 54:
        return 0
    size, _, pixels, header, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", b, at + 2)
    if planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or header not in (40, 108, 124) or width <= 0 or not height or at + size > len(b):
        return 0
    return size if pixels + (width * bits + 31) // 32 * 4 * abs(height) == size else 0


def check_png(v: Value, at: int) -> int:
    """To the end chunk; each chunk's checksum is computed once."""
    b = v.view
    if len(b) < at + 33 or bytes(b[at + 8 : at + 16]) != b"\0\0\0\rIHDR" or zlib.crc32(b[at + 12 : at + 29]) != struct.unpack_from(">I", b, at + 29)[0]:
        return 0

    def step(p: int) -> tuple[int, bool]:
        if p + 12 > len(b):
            return -1, True
        n, name = struct.unpack_from(">I4s", b, p)
        if p + 12 + n > len(b) or name == b"IHDR" or zlib.crc32(b[p + 4 : p + 8 + n]) != struct.unpack_from(">I", b, p + 8 + n)[0]:
            return -1, True
        return p + 12 + n, name == b"IEND"

    end = v.end("png", at + 33, step)
    return end - at if end >= 0 else 0


def check_gif(v: Value, at: int) -> int:
    """Walks the blocks of a GIF to its trailer."""
    b = v.view
    if len(b) - at < 14:
        return 0

    def colours(flags: int) -> int:
        return 3 << ((flags & 7) + 1) if flags & 0x80 else 0

    def part(p: int) -> tuple[int, bool]:
        return (p + b[p] + 1, False) if p < len(b) and b[p] else (p + 1, True)

    def block(p: int) -> tuple[int, bool]:
        if p >= len(b):
            return -1, True
        if b[p] == 0x3B:
            return p + 1, True
        if b[p] == 0x21:
            return v.end("gif parts", p + 2, part), False
        if b[p] == 0x2C and p + 10 < len(b):
            return v.end("gif parts", p + 11 + colours(b[p + 9]), part), False
        return -1, True

    end = v.end("gif", at + 13 + colours(b[at + 10]), block)
    return end - at if end >= 0 else 0


def check_jpeg(v: Value, at: int) -> int:
    b = v.view

    def step(p: int) -> tuple[int, bool]:
        if p + 4 > len(b) or b[p] != 0xFF:
            return -1, True
        mark, n = b[p + 1], struct.unpack_from(">H", b, p + 2)[0]
        if not 0xC0 <= mark <= 0xFE or 0xD0 <= mark <= 0xD9 or n < 2 or p + 2 + n > len(b):
            return -1, True
        if mark != 0xDA:
            return p + 2 + n, False
        end = v.after(b"\xff\xd9", p + 2 + n)
        return (end + 2 if end >= 0 else -1), True

    end = v.end("jpeg", at + 2, step)
    return end - at if end >= 0 else 0


def check_pdf(v: Value, at: int) -> int:
    """To the last end mark before another header; an update of a file has marks of its own."""
    if not v.data[at + 5 : at + 6].isdigit() or v.data[at + 6 : at + 7] != b".":
        return 0
    limit = v.after(b"%PDF-", at + 1)
    ends = v.places(b"%%EOF")
    k = bisect_left(ends, limit if limit >= 0 else len(v.data)) - 1
    start = v.after(b"startxref", at)
    return ends[k] + 5 - at if k >= 0 and at < start < ends[k] else 0


def check_zip(v: Value, at: int) -> int:
    end = v.after(b"PK\x05\x06", at)
    if end < 0 or len(v.data) < end + 22:
        return 0
    size, start, note = struct.unpack_from("<IIH", v.data, end + 12)
    return end + 22 + note - at if start + size == end - at and len(v.data) >= end + 22 + note else 0


#: Magic bytes, media type, validator.
FORMATS: list[tuple[bytes, str, Callable[[Value, int], int]]] = [
    (b"RIFF", "audio/wav", check_wav),
    (b"BM", "image/bmp", check_bmp),
    (b"\x89PNG\r\n\x1a\n", "image/png", check_png),
    (b"GIF87a", "image/gif", check_gif),
    (b"GIF89a", "image/gif", check_gif),
    (b"\xff\xd8\xff", "image/jpeg", check_jpeg),
    (b"%PDF-", "application/pdf", check_pdf),
    (b"PK\x03\x04", "application/zip", check_zip),
]


class Sniffer:
    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        for k, (magic, _, _) in enumerate(FORMATS):
            self.automaton.add_word(magic.decode("latin-1"), k)
        self.automaton.make_automaton()

    def find(self, value: bytes) -> list[Found]:
        """Objects by offset whose structure holds, those inside others included."""
        held, out = Value(value), []
        for end, k in self.automaton.iter(value.decode("latin-1")):
            magic, kind, valid = FORMATS[k]
            at = end + 1 - len(magic)
            if size := valid(held, at):
                out.append(Found(kind, at, size))
        return sorted(out, key=lambda x: (x.offset, -x.size))

    def true_type(self, value: bytes) -> tuple[str, list[Found]]:
        """(type of the whole value, objects carved from it)."""
        found = self.find(value)
        whole = next((x for x in found if x.offset == 0 and x.size == len(value)), None)
        return (whole.kind if whole else UNKNOWN), [x for x in found if x is not whole]


def put_wav(payload: bytes) -> bytes:
    head = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, 8000, 8000, 1, 8)
    return struct.pack("<4sI4s", b"RIFF", 4 + len(head) + 8 + len(payload), b"WAVE") + head + struct.pack("<4sI", b"data", len(payload)) + payload


def put_bmp(payload: bytes) -> bytes:
    """Grey bitmap of UNIT columns, rows from the bottom as the format has them."""
    rows = len(payload) // UNIT
    palette = b"".join(bytes((k, k, k, 0)) for k in range(256))
    turned = b"".join(payload[k * UNIT : (k + 1) * UNIT] for k in range(rows - 1, -1, -1))
    head = struct.pack("<IIIIiiHHIIIIII", 54 + 1024 + len(payload), 0, 54 + 1024, 40, UNIT, rows, 1, 8, 0, len(payload), 2835, 2835, 256, 0)
    return b"BM" + head + palette + turned


def put_png(payload: bytes) -> bytes:
    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    rows = len(payload) // UNIT
    raw = b"".join(b"\0" + payload[k * UNIT : (k + 1) * UNIT] for k in range(rows))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", UNIT, rows, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 1)) + chunk(b"IEND", b"")


def get_wav(b: bytes) -> bytes:
    place = 12
    while b[place : place + 4] != b"data":
        n = struct.unpack_from("<I", b, place + 4)[0]
        place += 8 + n + (n & 1)
    return b[place + 8 : place + 8 + struct.unpack_from("<I", b, place + 4)[0]]


def get_bmp(b: bytes) -> bytes:
    start, (width, height) = struct.unpack_from("<I", b, 10)[0], struct.unpack_from("<ii", b, 18)
    return b"".join(b[start + k * width : start + (k + 1) * width] for k in range(height - 1, -1, -1))


def get_png(b: bytes) -> bytes:
    """Pixels of an 8-bit grey PNG whose rows have no filter."""
    width, place, data = struct.unpack_from(">I", b, 16)[0], 8, []
    while place < len(b):
        n, name = struct.unpack_from(">I4s", b, place)
        if name == b"IDAT":
            data.append(b[place + 8 : place + 8 + n])
        place += 12 + n
    raw = zlib.decompress(b"".join(data))
    return b"".join(raw[k + 1 : k + 1 + width] for k in range(0, len(raw), width + 1))


STORES = [("audio/wav", put_wav, get_wav), ("image/bmp", put_bmp, get_bmp), ("image/png", put_png, get_png)]
READERS = {kind: get for kind, _, get in STORES}


def padded(text: str | None) -> tuple[int, bytes]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return len(data), data + b" " * (-len(data) % UNIT if data else UNIT)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts as stored media: the id, bytes, the media and a declared type, which is wrong for two of three."""

    def make():
        def one(doc_id, text):
            n, payload = padded(text)
            k = zlib.crc32(payload) % len(STORES)
            return doc_id, n, STORES[k][1](payload), STORES[(zlib.crc32(payload) >> 8) % len(STORES)][0]

        return one

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), make, "doc_id long, n_bytes long, media binary, declared string")


def sniff(media: DataFrame, value_col: str = "media", declared_col: str = "declared", id_col: str = "doc_id") -> DataFrame:
    """Per row: the true type, whether the declared one was wrong, and the objects carved from the value.

    Outermost objects come with their bytes; one that begins inside another that came is named by its place and size
    and has null content, so what a value gives is never longer than it, however its objects are nested.
    """

    def make():
        sniffer = Sniffer()

        def one(key, value, declared):
            kind, inside = sniffer.true_type(value or b"")
            carved, reach = [], 0
            for x in inside:  # by offset, the longest first
                carved.append((x.kind, x.offset, x.size, value[x.offset : x.offset + x.size] if x.offset >= reach else None))
                reach = max(reach, x.offset + x.size)
            return key, kind, kind != declared, carved

        return one

    return map_rows(media.select(F.col(id_col).cast("long"), value_col, F.col(declared_col).cast("string")), make, "doc_id long, kind string, corrected boolean, carved array<struct<kind: string, offset: long, size: long, content: binary>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored bytes are read back by the type that sniffing found, not by the declared one."""

    def make():
        sniffer = Sniffer()

        def one(doc_id, n, media, declared):
            media = bytes(media)
            kind, inside = sniffer.true_type(media)
            payload = READERS[kind](media)
            inner = sniffer.find(payload)
            feature = f"{kind};declared={declared};corrected={int(kind != declared)};carved={len(inside)};in_payload={len(inner)};size={len(media)}"
            return doc_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-TAIL:]), len(media), hashlib.sha256(media).hexdigest(), feature

        return one

    stored = store(table(spark, sf_dir, "documents"))
    return map_rows(stored, make, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
