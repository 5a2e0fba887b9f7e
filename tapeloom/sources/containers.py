"""How long an audio file plays, from its headers: chunks of WAV (RIFF, RF64), boxes of MP4 (M4A).

Readers go from header to header and jump over samples, so that a file costs a few small reads whatever its
length. A file that ends before a chunk or box that it announces is an error, not a shorter duration. The
duration is that of whole milliseconds, rounded half to even, as decoders that count frames give it.
"""

from __future__ import annotations

import struct
from io import BytesIO
from typing import BinaryIO

from tapeloom.shipping import ship
from tapeloom.sources.exact import open_folder

ship(__name__)

#: Boxes that hold boxes on the way to a duration.
HOLDERS = (b"moov", b"mvex")
UNKNOWN_32, UNKNOWN_64 = 0xFFFFFFFF, 0xFFFFFFFFFFFFFFFF


def _read(f: BinaryIO, n: int) -> bytes:
    got = f.read(n)
    if len(got) < n:
        raise ValueError("the file is cut short")
    return got


def _milliseconds(count: int, per_second: int) -> int:
    """Rounded half to even in whole numbers."""
    if per_second <= 0:
        raise ValueError("no rate")
    whole, rest = divmod(1000 * count, per_second)
    return whole + (2 * rest > per_second or (2 * rest == per_second and whole % 2))


def _wav(f: BinaryIO, size: int) -> int:
    rate = frame = large = None
    at = 12
    while at + 8 <= size:
        f.seek(at)
        kind, length = struct.unpack("<4sI", _read(f, 8))
        body = at + 8
        if kind == b"ds64":  # 64-bit sizes, of RF64
            large = struct.unpack("<QQ", _read(f, 16))[1]
        elif kind == b"fmt ":
            _, _, rate, _, frame, _ = struct.unpack("<HHIIHH", _read(f, 16))
        elif kind == b"data":
            if rate is None:
                raise ValueError("samples come before their format")
            if length == UNKNOWN_32:
                length = large if large is not None else size - body
            if body + length > size:
                raise ValueError("the file is cut short")
            if not frame:
                raise ValueError("no rate")
            return _milliseconds(length // frame, rate)
        at = body + length + length % 2
    raise ValueError("the file is cut short" if at > size else "no samples")


def _header_duration(f: BinaryIO) -> tuple[int, int | None]:
    """Units a second, and how many units; None if that is not known."""
    version = _read(f, 4)[0]
    if version == 1:
        _, _, scale, units = struct.unpack(">QQIQ", _read(f, 28))
        return scale, None if units == UNKNOWN_64 else units
    _, _, scale, units = struct.unpack(">IIII", _read(f, 16))
    return scale, None if units == UNKNOWN_32 else units


def _mp4(f: BinaryIO, size: int) -> int:
    scale = units = fragments = None
    ends = [size]
    at = 0
    while at < size:
        while len(ends) > 1 and at >= ends[-1]:
            ends.pop()
        f.seek(at)
        length, kind = struct.unpack(">I4s", _read(f, 8))
        head = 8
        if length == 1:
            length, head = struct.unpack(">Q", _read(f, 8))[0], 16
        elif length == 0:  # up to the end of what holds it
            length = ends[-1] - at
        if length < head or at + length > ends[-1]:
            raise ValueError("the file is cut short" if at + length > size else "a box is larger than what holds it")
        if kind == b"mvhd":
            scale, units = _header_duration(f)
        elif kind == b"mehd":  # of a file in fragments
            version = _read(f, 4)[0]
            fragments = struct.unpack(">Q" if version else ">I", _read(f, 8 if version else 4))[0]
        if kind in HOLDERS:
            ends.append(at + length)
            at += head
        else:
            at += length
    if scale is None:
        raise ValueError("no movie header")
    if not units and fragments is None:
        raise ValueError("no duration")
    return _milliseconds(units or fragments, scale)


def duration_ms(f: BinaryIO, size: int) -> int:
    """Of an open file that can be read from any place."""
    f.seek(0)
    head = f.read(12)
    if head[:4] in (b"RIFF", b"RF64") and head[8:] == b"WAVE":
        return _wav(f, size)
    if head[4:8] in (b"ftyp", b"moov", b"mdat", b"free", b"skip", b"wide"):
        return _mp4(f, size)
    raise ValueError("neither WAV nor MP4")


def content_duration_ms(content: bytes) -> int:
    """Of a file's content, for stores that only Spark reads: a decoder for ``adapters.with_durations``."""
    return duration_ms(BytesIO(content), len(content))


def file_duration_ms(path: str) -> int:
    """Of a file; only its headers are read."""
    system, inner = open_folder(path)
    with system.open_input_file(inner) as f:
        return duration_ms(f, f.size())


def wav(samples: bytes, rate: int = 8000, frame: int = 1) -> bytes:
    """A WAV file of 8-bit samples, ``frame`` channels of them."""
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, frame, rate, rate * frame, frame, 8)
    data = struct.pack("<4sI", b"data", len(samples)) + samples + b"\0" * (len(samples) % 2)
    return struct.pack("<4sI4s", b"RIFF", 4 + len(fmt) + len(data), b"WAVE") + fmt + data


def mp4(samples: bytes, units: int, scale: int = 1000) -> bytes:
    """An MP4 file with its samples before the header that tells the duration."""

    def box(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I4s", 8 + len(body), kind) + body

    header = struct.pack(">IIIII", 0, 0, 0, scale, units) + b"\0" * 80
    return box(b"ftyp", b"M4A \0\0\0\0") + box(b"mdat", samples) + box(b"moov", box(b"mvhd", header))
