"""Operator 5: round trip and salvage."""

import base64
import gzip
import hashlib
import re
import time
import zlib

import pytest

from tapeloom.llm import warc


def brute(pages):
    first = {}
    for p, _, h in pages:
        h = h or ""
        if p is not None and (h not in first or p < first[h]):
            first[h] = p
    out = []
    for p, _, h in pages:
        raw = (h or "").encode()
        f = first.get(h or "")
        again = f is not None and p != f
        out.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    rows += [(9001, "u\r\nx", "WARC/1.1\r\n\r\n\r\nWARC/1.0\r\n"), (9000, "u", "WARC/1.1\r\n\r\n\r\nWARC/1.0\r\n"), (9002, None, None), (9003, "", ""), (9004, "é", "é\n\r\n😀"), (None, "a", ""), (9002, "b", ""), (9005, "c", "x" * 300000), (-1, "d", "x" * 300000), (6400, "e", "é" + "y z" * 2_000_000), (-64, "f", None), (6464, "g", "".join(map(chr, range(32, 3000))))]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    got = [tuple(r) for r in warc.warc_report(pages).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_damage_elsewhere_is_reported(spark, monkeypatch):
    pages = spark.createDataFrame([(i, "u", f"page {i}") for i in range(100)], "page_id long, url string, html string")
    monkeypatch.setattr(warc, "member", lambda record, make=warc.member: make(record)[:60] if b"page 7\r\n" in record else make(record))
    with pytest.raises(RuntimeError, match="3 gaps and 99 records were read of 2 and 100"):
        warc.warc_report(pages)


def test_large_damaged_files_take_linear_time():
    body = b"".join(hashlib.sha256(b"%d" % i).digest() for i in range(2000))
    za = gzip.compress(record(0, body))

    def took(n):
        data = (za[: len(za) // 2] + za) * n
        began = time.perf_counter()
        rows = list(warc.read_archive(data))
        assert [r[0] for r in rows] == ["gap", "record"] * n
        return time.perf_counter() - began

    took(10)
    half, whole = took(150), took(300)
    assert whole < 3 * half + 1


def test_empty(spark):
    assert warc.warc_report(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def record(n, body, digest=True):
    d = base64.b32encode(hashlib.sha1(body).digest()).decode()
    return f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x-page:{n}>\r\nWARC-Block-Digest: sha1:{d}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def ids(data):
    return [r[3]["warc-record-id"][12:-1] if r[0] == "record" else (r[1], r[2]) for r in warc.read_archive(data)]


def test_salvage():
    a, b, c = (record(i, bytes([65 + i]) * 40 + b"WARC/1.0\r\nnot a record") for i in range(3))
    assert ids(a + b + c) == ["0", "1", "2"]
    assert ids(a + b[:-30] + c) == ["0", (len(a), len(a) + len(b) - 30), "2"]
    broken = b.replace(b"BBBB", b"BXBB")
    assert ids(a + broken + c) == ["0", (len(a), len(a + b)), "2"]
    assert ids(b"junk" + a) == [(0, 4), "0"]
    assert ids(a + b"tail") == ["0", (len(a), len(a) + 4)]
    za, zb, zc = map(gzip.compress, (a, b, c))
    assert ids(za + zb + zc) == ["0", "1", "2"]
    bad = zb[:20] + b"\x00\x00\x00" + zb[23:]
    assert ids(za + bad + zc) == ["0", (len(za), len(za + zb)), "2"]
    assert ids(za + b"\n" + zc) == ["0", (len(za), len(za) + 1), "2"]
    assert ids(za + b + zc) == ["0", "1", "2"]
    assert ids(b"") == []


def test_salvage_in_members():
    noise = [hashlib.sha256(b"%d" % i).hexdigest().encode() * 20 + b"%d" % i * 900 for i in range(40)]
    a, b, c = (record(i, bytes([65 + i]) * 40 + b"WARC/1.0\r\nnot a record") for i in range(3))
    broken = b.replace(b"BBBB", b"BXBB")
    z = gzip.compress(a + broken + c)
    assert ids(z) == ["0", (0, len(z)), "2"]
    assert ids(gzip.compress(a) + b + gzip.compress(c)) == ids(a + gzip.compress(b) + c) == ids(a + gzip.compress(b + c)) == ["0", "1", "2"]
    assert ids(a + broken + gzip.compress(c)) == ["0", (len(a), len(a + broken)), "2"]
    many = [record(i, x) for i, x in enumerate(noise)]
    for level in (0, 1, 9):
        z = gzip.compress(b"".join(many), level)
        assert ids(z) == [str(i) for i in range(40)]
        for cut in (len(z) - 1, len(z) - 9, len(z) * 3 // 4, len(z) // 2, 700):
            whole = zlib.decompressobj(31).decompress(z[:cut])
            n = sum(len(b"".join(many[: k + 1])) <= len(whole) for k in range(40))
            # Truncated at the end of the file, and before another member: no record lost or twice, one gap up to there.
            for tail, more in ((b"", []), (gzip.compress(c) + a, ["2", "0"])):
                got = ids(z[:cut] + tail)
                assert [x for x in got if isinstance(x, str)] == [str(i) for i in range(n)] + more
                assert level == 0 or [x[1] for x in got if isinstance(x, tuple)] == [cut]
    z = gzip.compress(b"".join(many))
    # Damage to the checksum leaves all records, in the middle those before; what has no digest is not trusted.
    got = ids(z[:-8] + bytes(8) + gzip.compress(c))
    assert [x for x in got if isinstance(x, str)] == [str(i) for i in range(40)] + ["2"] and len(got) == 42
    at = len(z) // 2
    got = [x for x in ids(z[:at] + bytes(200) + z[at + 200 :]) if isinstance(x, str)]
    assert 10 < len(got) and got == sorted(set(got), key=int)
    bare = [re.sub(rb"WARC-Block-Digest.*\r\n", b"", x) for x in many]
    z = gzip.compress(b"".join(bare))
    assert len([x for x in ids(z[:-9]) if isinstance(x, str)]) == 40
    assert ids(z[:-8] + bytes(8)) == [(0, len(z))]


def test_salvage_in_spark(spark, tmp_path):
    a, b = record(0, b"a"), record(1, b"b")
    (tmp_path / "x.warc").write_bytes(a[:-2] + b)
    rows = warc.read_archives(spark, str(tmp_path)).orderBy("start").collect()
    assert [(r.kind, r.start, r.end) for r in rows] == [("gap", 0, len(a) - 2), ("record", len(a) - 2, len(a) + len(b) - 2)]
    assert bytes(rows[1].payload) == b"b"
