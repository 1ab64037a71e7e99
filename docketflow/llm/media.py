"""Operator 8, media columns: MPEG audio.

`frames` wraps a payload as an MPEG-1 Layer III mono stream: an ID3v2.3 tag with the payload's
length, an Xing frame with counts and a table of contents, and frames of variable bitrate whose
granules are empty (side information zero, so they decode as silence) and whose rest, the
ancillary data, carries the payload bytes unchanged. Each frame has the standard's CRC-16 over its
header and side information.

`parse` knows nothing of the writer: it reads ID3v2.2 to 2.4 tags, resynchronises on frame headers of
Layers I, II and III (a header counts when another header or the end follows at its length), parses
Xing and VBRI tables by the fields that their flags and sizes announce and no further than the data
go, verifies checksums (of Layers I and III; those of Layer II are counted as unverified) and gives
the exact duration in samples, and the seek offset of every frame.

Null and empty texts are 64 zero bytes. Equal texts give equal files. Long texts are framed whole. A
stream without any valid frame parses to zero frames and an empty payload; a table cut short has
only the fields that are there. Repeated rows, rows without an id and rows that share one are stored
each on its own, with the id they have. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm.common import sub_batches

# Fixed values of ISO/IEC 11172-3 and 13818-3: kbit/s by index (MPEG-1 Layers III, II, I, then MPEG-2 Layers III and II, I), Hz by index, CRC polynomial.
RATES_V1 = (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320)
RATES_V1_II = (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384)
RATES_V1_I = (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448)
RATES_V2_I = (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256)
RATES_V2 = (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160)
HERTZ_V1 = (44100, 48000, 32000)
POLYNOMIAL = 0x8005
SAMPLES_V1, SAMPLES_V2 = 1152, 576
UNIT = 64


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 8
        for _ in range(8):
            c = (c << 1) ^ (POLYNOMIAL if c & 0x8000 else 0)
        out.append(c & 0xFFFF)
    return out


_CRC = _crc_table()


def crc16(data: bytes) -> int:
    """The checksum of MPEG audio: polynomial 0x8005, start 0xFFFF, high bit first."""
    c = 0xFFFF
    for b in data:
        c = (c << 8 & 0xFFFF) ^ _CRC[(c >> 8) ^ b]
    return c


def padded(text: str | None, unit: int = UNIT) -> tuple[bytes, int]:
    """UTF-8 bytes filled with zeros to a positive multiple of unit, and the number before filling."""
    raw = (text or "").encode("utf-8")
    want = max(unit, -(-len(raw) // unit) * unit)
    return raw.ljust(want, b"\0"), len(raw)


SIDE = 17  # bytes of side information of a mono MPEG-1 frame
_HEADS: dict[int, tuple[bytes, int]] = {}
for _i in range(1, 15):
    _h = bytes((0xFF, 0xFA, _i << 4, 0xC0))
    _HEADS[_i] = (_h + struct.pack(">H", crc16(_h[2:] + bytes(SIDE))) + bytes(SIDE), 144000 * RATES_V1[_i] // HERTZ_V1[0])


def frames(payload: bytes) -> bytes:
    """The payload as an MPEG audio stream."""
    biggest, size = _HEADS[14]
    room = size - len(biggest)
    body = [biggest + payload[k : k + room] for k in range(0, len(payload) - len(payload) % room, room)]
    rest = payload[len(payload) - len(payload) % room :]
    if rest:
        head, size = next(x for _, x in sorted(_HEADS.items()) if x[1] - len(x[0]) >= len(rest))
        body.append(head + rest.ljust(size - len(head), b"\0"))
    starts = [0]
    for b in body:
        starts.append(starts[-1] + len(b))
    head, size = _HEADS[9]
    total = size + starts[-1]
    toc = bytes(min(255, (size + starts[k * len(body) // 100]) * 256 // total) for k in range(100))
    xing = head[:4] + struct.pack(">H", crc16(head[2:4] + bytes(SIDE))) + bytes(SIDE) + b"Xing" + struct.pack(">III", 7, len(body), total) + toc
    text = b"\0payload_bytes\0" + str(len(payload)).encode()
    tag = b"TXXX" + struct.pack(">IH", len(text), 0) + text
    n = len(tag)
    id3 = b"ID3\x03\0\0" + bytes((n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127)) + tag
    return id3 + xing.ljust(size, b"\0") + b"".join(body)


@dataclass
class Table:
    """A variable-bitrate table: what it states; None or empty where it states nothing or is cut short."""

    kind: str
    frames: int | None = None
    bytes: int | None = None
    quality: int | None = None
    toc: list[int] = field(default_factory=list)  # Xing: 256ths of the file at each percent; VBRI: bytes of each stretch


@dataclass
class Parsed:
    tags: dict[str, str] = field(default_factory=dict)
    frames: int = 0
    samples: int = 0
    hertz: int = 0
    layers: set[int] = field(default_factory=set)
    bad_checksums: int = 0
    unverified: int = 0
    skipped: int = 0  # bytes outside tags and frames
    table: Table | None = None
    offsets: list[int] = field(default_factory=list)  # of every audio frame
    rates: dict[int, int] = field(default_factory=dict)  # kbit/s: frames
    payload: bytes = b""

    @property
    def seconds(self) -> float:
        return self.samples / self.hertz if self.hertz else 0.0


class Header(NamedTuple):
    length: int
    samples: int
    hertz: int
    kbits: int
    layer: int
    protected: bool
    side: int  # bytes after the header (and checksum) before the main data; Layer III only
    covered: int  # of which the checksum covers so many; -1 if it isn't verified


def header(data: bytes, at: int) -> Header | None:
    """The frame header at a place, or None."""
    if at + 4 > len(data) or data[at] != 0xFF or data[at + 1] & 0xE0 != 0xE0:
        return None
    version, layer = data[at + 1] >> 3 & 3, 4 - (data[at + 1] >> 1 & 3)  # version 3: MPEG-1, 2: MPEG-2, 0: MPEG-2.5
    rate, hz, pad = data[at + 2] >> 4, data[at + 2] >> 2 & 3, data[at + 2] >> 1 & 1
    if version == 1 or layer == 4 or rate in (0, 15) or hz == 3:
        return None
    one, mono = version == 3, data[at + 3] >> 6 == 3
    hertz = HERTZ_V1[hz] >> (0 if one else 1 if version == 2 else 2)
    protected = not data[at + 1] & 1
    if layer == 1:
        kbits = (RATES_V1_I if one else RATES_V2_I)[rate]
        joint = 4 + 4 * (data[at + 3] >> 4 & 3) if data[at + 3] >> 6 == 1 else 32  # subbands of two channels
        return Header((12000 * kbits // hertz + pad) * 4, 384, hertz, kbits, 1, protected, 0, 16 if mono else (joint * 2 + 32 - joint) // 2)
    if layer == 2:
        kbits = (RATES_V1_II if one else RATES_V2)[rate]
        return Header(144000 * kbits // hertz + pad, SAMPLES_V1, hertz, kbits, 2, protected, 0, -1)
    kbits = (RATES_V1 if one else RATES_V2)[rate]
    side = (17 if mono else 32) if one else (9 if mono else 17)
    return Header((144000 if one else 72000) * kbits // hertz + pad, SAMPLES_V1 if one else SAMPLES_V2, hertz, kbits, 3, protected, side, side)


def id3(data: bytes) -> tuple[dict[str, str], int]:
    """User-defined texts of an ID3v2 tag at the start, by name, and where the tag ends (0 without one)."""
    tags: dict[str, str] = {}
    if data[:3] != b"ID3" or len(data) < 10:
        return tags, 0
    seven = lambda x: sum((v & 127) << 7 * (len(x) - 1 - k) for k, v in enumerate(x))
    version, flags = data[3], data[5]
    stop = min(len(data), 10 + seven(data[6:10]))
    body = data[10:stop]
    if flags & 0x80 and version < 4:  # unsynchronised: a zero after each 0xFF was put in
        body = body.replace(b"\xff\0", b"\xff")
    p, wide = 0, 4 if version > 2 else 3
    if flags & 0x40 and version > 2 and len(body) >= 4:  # an extended header
        p = seven(body[:4]) if version > 3 else 4 + int.from_bytes(body[:4], "big")
    while p + (10 if wide == 4 else 6) <= len(body) and body[p]:
        name, size = body[p : p + wide], body[p + wide : p + 2 * wide]
        n = seven(size) if version > 3 else int.from_bytes(size, "big")
        p += 10 if wide == 4 else 6
        if name in (b"TXXX", b"TXX") and n:
            kind = body[p] if p < len(body) else 0
            code = {1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(kind, "latin-1")
            key, _, value = body[p + 1 : p + n].decode(code, "replace").partition("\0")
            tags[key.lstrip("\ufeff")] = value.lstrip("\ufeff").rstrip("\0")
        p += n
    return tags, min(len(data), stop + 10 * bool(flags & 0x10))


def table(frame: bytes, side: int, body: int) -> Table | None:
    """The variable-bitrate table that a Layer III frame holds in place of sound, or None."""
    number = lambda at, n: int.from_bytes(frame[at : at + n], "big") if at + n <= len(frame) else None
    for at in dict.fromkeys((body, 4 + side)):
        kind = frame[at : at + 4]
        flags = number(at + 4, 4)
        if kind in (b"Xing", b"Info"):
            out, p = Table(kind.decode()), at + 8
            if flags is None:
                return out
            if flags & 1:
                out.frames, p = number(p, 4), p + 4
            if flags & 2:
                out.bytes, p = number(p, 4), p + 4
            if flags & 4:
                out.toc, p = list(frame[p : p + 100]) if p + 100 <= len(frame) else [], p + 100
            if flags & 8:
                out.quality = number(p, 4)
            return out
    if frame[36:40] == b"VBRI":
        out = Table("VBRI", number(50, 4), number(46, 4), number(44, 2))
        count, scale, width = number(54, 2) or 0, number(56, 2) or 1, number(58, 2) or 0
        if 1 <= width <= 4 and 62 + count * width <= len(frame):
            out.toc = [scale * number(62 + k * width, width) for k in range(count)]
        return out
    return None


def parse(data: bytes) -> Parsed:
    """Read an MPEG audio stream, whoever wrote it."""
    out, end = Parsed(), len(data)
    out.tags, at = id3(data)
    if data[-128:-125] == b"TAG" and end - at >= 128:
        end -= 128
    parts, first = [], True
    while at < end:
        h = header(data, at)
        if h is None or at + h.length > end or (at + h.length < end and header(data, at + h.length) is None):
            nxt = data.find(b"\xff", at + 1, end)
            nxt = end if nxt < 0 else nxt
            out.skipped += nxt - at
            at = nxt
            continue
        start = at + 4 + 2 * h.protected
        if h.protected and h.covered < 0:
            out.unverified += 1
        elif h.protected and crc16(data[at + 2 : at + 4] + data[start : start + h.covered]) != int.from_bytes(data[at + 4 : at + 6], "big"):
            out.bad_checksums += 1
        body = start + h.side
        if first and h.layer == 3 and (stated := table(data[at : at + h.length], h.side, body - at)):
            out.table = stated
        else:
            out.frames += 1
            out.samples += h.samples
            out.hertz = h.hertz
            out.layers.add(h.layer)
            out.offsets.append(at)
            out.rates[h.kbits] = out.rates.get(h.kbits, 0) + 1
            parts.append(data[body : at + h.length])
        first = False
        at += h.length
    out.payload = b"".join(parts)
    if out.tags.get("payload_bytes", "").isdecimal():
        out.payload = out.payload[: int(out.tags["payload_bytes"])]
    return out


def media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the stored stream and what parsing it gives: durations in samples, seek offsets, checks, payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in sub_batches(big, text_col, 2 << 20):
                rows = []
                for t in b.column(1).to_pylist():
                    payload, n = padded(t)
                    stored = frames(payload)
                    p = parse(stored)
                    rows.append((n, stored, p.payload, p.frames, p.samples, p.hertz, p.bad_checksums, p.skipped, p.table.frames if p.table else None, p.offsets, " ".join(f"{k}:{v}" for k, v in sorted(p.rates.items()))))
                cols = [*zip(*rows, strict=True)]
                kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string()]
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "n_bytes", "media", "payload", "frames", "samples", "hertz", "bad_checksums", "skipped", "table_frames", "seek_offsets", "rates"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias(text_col)).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, media binary, payload binary, frames long, samples long, hertz int, bad_checksums long, skipped long, table_frames long, seek_offsets array<long>, rates string"
    )


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as MPEG audio and read back; digests and features of the stored form."""
    m = media(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    feature = F.concat_ws(";", F.concat(F.lit("frames="), "frames"), F.concat(F.lit("samples="), "samples"), F.concat(F.lit("hz="), "hertz"), F.concat(F.lit("bad="), "bad_checksums"), F.concat(F.lit("rates="), "rates"), F.concat(F.lit("seek="), F.hex(F.crc32(F.concat_ws(",", "seek_offsets")))), F.concat(F.lit("payload="), F.hex(F.crc32("payload"))))
    return m.select(
        "doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -64, 64)")).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        feature.alias("feature"), "frames", "samples", "hertz", (F.col("samples") / F.col("hertz")).alias("seconds"), "seek_offsets",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op8_media": op8_media}


def expected(text: str | None) -> tuple[int, int, str, int]:
    """n_bytes, payload_bytes, payload_sha256 and tail_crc32 straight from a text, for tests."""
    payload, n = padded(text)
    return n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])
