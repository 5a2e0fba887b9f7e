"""Durations from headers."""

import io
import struct
import wave

import pytest

from tapeloom.sources import adapters, containers, files


def box(kind, body, size=None):
    return struct.pack(">I4s", 8 + len(body) if size is None else size, kind) + body


def mvhd(scale, units, version=0):
    if version:
        return box(b"mvhd", b"\1\0\0\0" + struct.pack(">QQIQ", 0, 0, scale, units) + b"\0" * 80)
    return box(b"mvhd", b"\0" * 4 + struct.pack(">IIII", 0, 0, scale, units) + b"\0" * 80)


def test_wav_as_the_standard_library_writes_it():
    for rate, width, channels, frames in ((8000, 1, 1, 12004), (44100, 2, 2, 44101), (48000, 3, 1, 0)):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(width)
            w.setframerate(rate)
            w.writeframes(b"\0" * (frames * width * channels))
        assert containers.content_duration_ms(out.getvalue()) == round(1000 * frames / rate)
    with wave.open(io.BytesIO(containers.wav(b"abc" * 5000)), "rb") as w:
        assert (w.getnframes(), w.getframerate()) == (15000, 8000)


GOOD = {
    "odd chunk first": (b"RIFF\0\0\0\0WAVE" + b"LIST\x03\0\0\0abc\0" + containers.wav(b"x" * 8000)[12:], 1000),
    "unknown length": (containers.wav(b"")[:-4] + b"\xff\xff\xff\xff" + b"x" * 16000, 2000),
    "half to even": (containers.wav(b"x" * 12), 2),
    "mp4": (containers.mp4(b"samples" * 99, 61_500), 61_500),
    "64 bits": (box(b"ftyp", b"isom") + struct.pack(">I4sQ", 1, b"mdat", 16 + 40) + b"x" * 40 + box(b"moov", mvhd(600, 600 * 7200, 1)), 7_200_000),
    "up to the end": (box(b"ftyp", b"isom") + box(b"moov", mvhd(1000, 5)) + box(b"mdat", b"x" * 99, 0), 5),
    "fragments": (box(b"ftyp", b"iso5") + box(b"moov", mvhd(1000, 0) + box(b"mvex", box(b"mehd", struct.pack(">II", 0, 4321)))) + box(b"moof", b"zz"), 4321),
}
BAD = {
    "empty": b"", "short": b"RIFF", "text": b"hello, world, hello", "no samples": containers.wav(b"xx")[:36], "cut": containers.wav(b"x" * 100)[:-1],
    "cut header": containers.wav(b"x" * 100)[:30], "data first": b"RIFF\0\0\0\0WAVEdata\2\0\0\0xx", "no moov": box(b"ftyp", b"isom") + box(b"mdat", b"x"),
    "cut box": containers.mp4(b"x" * 50, 9)[:-5], "cut samples": box(b"ftyp", b"isom") + box(b"mdat", b"x", 5000), "no scale": box(b"ftyp", b"") + box(b"moov", mvhd(0, 9)),
    "box in box": box(b"ftyp", b"") + box(b"moov", box(b"mvhd", b"x" * 10, 900)) + b"x" * 2000, "tiny box": box(b"ftyp", b"") + box(b"free", b"", 3), "unknown": box(b"ftyp", b"") + box(b"moov", mvhd(1000, 0xFFFFFFFF)),
}


@pytest.mark.parametrize("name", GOOD)
def test_good(name):
    content, ms = GOOD[name]
    assert containers.content_duration_ms(content) == ms


@pytest.mark.parametrize("name", BAD)
def test_bad(name):
    with pytest.raises(ValueError):
        containers.content_duration_ms(BAD[name])


def test_only_headers_are_read():
    class Counting(io.BytesIO):
        n = 0

        def read(self, k=-1):
            got = super().read(k)
            self.n += len(got)
            return got

    for content in (containers.wav(b"x" * 10_000_000), containers.mp4(b"x" * 10_000_000, 5)):
        f = Counting(content)
        containers.duration_ms(f, len(content))
        assert f.n < 200


def test_files(spark, tmp_path):
    for name, (content, _) in GOOD.items():
        (tmp_path / f"{name} é%20.m4a").write_bytes(content)
    for name, content in BAD.items():
        (tmp_path / f"bad {name}.wav").write_bytes(content)
    rows = files.list_audio(spark, str(tmp_path))
    assert "content" not in rows.columns
    got = {r.filename: (r.duration_s, r.duration_error) for r in adapters.with_file_durations(rows).collect()}
    assert {n: got[f"{n} é%20"] for n in GOOD} == {n: (ms / 1000, None) for n, (_, ms) in GOOD.items()}
    assert all(got[f"bad {n}"][0] is None and got[f"bad {n}"][1].startswith("ValueError") for n in BAD if n != "empty") and "bad empty" not in got
    same = adapters.with_durations(files.read_audio(spark, str(tmp_path)), containers.content_duration_ms)
    assert {r.filename: (r.duration_s, r.duration_error) for r in same.collect()} == got
