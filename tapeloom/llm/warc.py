"""Operator 5, WARC: records written by Spark's text writer, read back by a reader that salvages.

Writing: one record for each page, its block an HTTP response whose payload is the page in UTF-8.
Of pages with equal payloads the one with the smallest id is a response, the others are revisits
that name it. A record is one gzip member and one row of the writer, whose line separator is an
empty gzip member, so that the archives are plain multi-member gzip and go wherever Spark can write.

Reading: archives come through Spark's binary reader, gzip members or plain. A record must start
with a version line, carry its length, end in two line breaks and match its digest. When a check
fails the reader searches for the next gzip member or version line that passes, goes on from there
and reports the bytes between as a quarantined gap. A member may hold many records: each that passes
is kept, and bytes between are a gap with the member's offsets. Of a member that breaks off or is
damaged, the records that inflate before the break are kept and the rest is a gap; in a damaged one
(its own checksum or coding fails) only records with a digest are, as nothing else vouches for them.

Defined results: a null page is empty; a null id makes a revisit of any equal page with an id, and
a response if there is none; rows that repeat the smallest id are all responses; an empty table
gives no archive and no rows; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.common import new_path, ship, written

ship(__name__)

#: Payloads under this many bytes are always responses.
LEAST_BYTES = 0
#: Records in one archive file at most; a file is read as a whole.
RECORDS_PER_FILE = 2_000
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"


def base32_of_hex(sha1: Column) -> Column:
    """Base32 of a SHA-1 in hex: each 10 hex digits are 8 of base32."""
    parts = [F.translate(F.lpad(F.conv(F.substring(sha1, 1 + 10 * i, 10), 16, 32), 8, "0"), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for i in range(4)]
    return F.concat(*parts)


def classified(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Adds payload, digest, n_bytes, first (the response that a revisit names, else null) to (page_id, url)."""
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", base32_of_hex(F.sha1(F.col("payload").cast("binary")))).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    # A row for each payload and task at most is shuffled, then the pages themselves by payload; a very common one is split on joining.
    firsts = rows.where(F.col("n_bytes") >= least).groupBy(F.col("digest").alias("d"), F.col("n_bytes").alias("b")).agg(F.min("page_id").alias("first"), F.count("*").alias("same")).where("same > 1").drop("same")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = rows.join(firsts, (F.col("digest") == F.col("d")) & (F.col("n_bytes") == F.col("b")), "left")
    return joined.select("page_id", "url", "payload", "digest", "n_bytes", F.when(revisit, F.col("first")).alias("first"))


def record_text(rows: DataFrame) -> Column:
    """A whole record but for the two line breaks that end it."""

    def urn(c: Column) -> Column:
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))

    is_revisit = F.col("first").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(CRLF * 2))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    profile = f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}WARC-Refers-To: "
    url = F.regexp_replace("url", r"[\r\n]", " ")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "),
        F.when(is_revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: "),
        urn(F.col("page_id")),
        F.lit(f"{CRLF}WARC-Date: {DATE}{CRLF}WARC-Target-URI: "),
        url,
        F.lit(CRLF),
        F.when(is_revisit, F.concat(F.lit(profile), urn(F.col("first")), F.lit(CRLF))).otherwise(""),
        F.lit("WARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.lit(f"{CRLF}WARC-Block-Digest: sha1:"),
        base32_of_hex(F.sha1(block.cast("binary"))),
        F.lit(f"{CRLF}X-Payload-Length: "),
        F.col("n_bytes").cast("string"),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(CRLF * 2),
        block,
    )


def member(record: bytes) -> bytes:
    """One gzip member, the same for the same bytes."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def _members(batches):
    import pyarrow as pa

    for b in batches:
        out = []
        for text, broken in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            good = member(text.encode() + b"\r\n\r\n")
            # What a writer that was stopped half way leaves, before it begins the record anew.
            out.append(good[: len(good) // 2] + good if broken else good)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES, broken: Column | None = None) -> None:
    """``broken``: pages (by page_id) before whose records half of a member is written too, to try the salvage reader."""
    rows = classified(pages, least)
    packed = rows.select(record_text(rows).alias("value"), F.coalesce(F.lit(False) if broken is None else broken, F.lit(False)).alias("broken")).mapInArrow(_members, "value binary")
    # The writer takes strings, and writes their bytes as they are.
    out = packed.select(F.col("value").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", member(b"").decode("latin-1"))
    out.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


# --- reading -------------------------------------------------------------------------------------

VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MEMBER = b"\x1f\x8b\x08"


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def parse_record(data, at: int) -> tuple[dict, bytes, int] | None:
    """Headers, block and end of the record at ``at``; None if any check fails."""
    if not VERSION.match(data, at):
        return None
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        return None
    head = {}
    for line in bytes(data[at:stop]).decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        head[name.strip().lower()] = value.strip()
    if not head.get("content-length", "").isdecimal() or "warc-record-id" not in head:
        return None
    begin = stop + 4
    end = begin + int(head["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return None
    block = bytes(data[begin:end])
    want = head.get("warc-block-digest")
    if want and want.removeprefix("sha1:") != _digest(block):
        return None
    return head, block, end + 4


def payload_of(head: dict, block: bytes) -> bytes:
    if head.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def record_at(data: bytes, at: int, proven: bool = False) -> tuple[dict, bytes, int] | None:
    """As ``parse_record``, with the payload digest of responses checked; ``proven`` asks for a digest."""
    got = parse_record(data, at)
    if not got:
        return None
    head, block, _ = got
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:") if head.get("warc-type") == "response" else ""
    if digest and digest != _digest(payload_of(head, block)):
        return None
    return got if digest or head.get("warc-block-digest") or not proven else None


def read_plain(data: bytes):
    """Yields ("record", start, end, headers, block) and ("gap", start, end, None, None)."""
    at, bad = 0, None
    while at < len(data):
        if got := record_at(data, at):
            if bad is not None:
                yield "gap", bad, at, None, None
                bad = None
            yield "record", at, got[2], got[0], got[1]
            at = got[2]
        else:
            bad = at if bad is None else bad
            found = VERSION.search(data, at + 1)
            at = found.start() if found else len(data)
    if bad is not None:
        yield "gap", bad, at, None, None


def inflate(data: bytes, begin: int, step: int = 16384) -> tuple[bytes, int, bool]:
    """The content of the gzip member at ``begin``, its end, and whether it is damaged.

    A broken member has end 0 and the content that comes before the break; it is not damaged if the data just stop."""
    unzip, out, at = zlib.decompressobj(31), [], begin
    try:
        while not unzip.eof and at < len(data):
            out.append(unzip.decompress(data[at : at + step]))
            at += step
    except zlib.error:
        return b"".join(out) + _before_damage(data, begin, at, step), 0, True
    return b"".join(out), min(at, len(data)) - len(unzip.unused_data) if unzip.eof else 0, False


def _before_damage(data: bytes, begin: int, at: int, step: int) -> bytes:
    """What the ``step`` bytes at ``at`` give before inflating fails in them: smaller and smaller steps, then the last byte's output one by one."""
    unzip, out = zlib.decompressobj(31), []
    for k in range(begin, at, step):
        unzip.decompress(data[k : k + step])
    while step:
        trial = unzip.copy()
        try:
            out.append(trial.decompress(data[at : at + step]))
            unzip, at = trial, at + step
        except zlib.error:
            step //= 2
    left = data[at : at + 1]
    try:
        while (got := unzip.decompress(left, 1)) or unzip.unconsumed_tail:
            out.append(got)
            left = unzip.unconsumed_tail
    except zlib.error:
        pass
    return b"".join(out)


def consumed(data: bytes, begin: int, n: int, step: int = 16384) -> int:
    """How far the gzip member at ``begin`` is read to give its first ``n`` bytes."""
    unzip, at = zlib.decompressobj(31), begin
    while n > 0 and at < len(data):
        piece = data[at : at + step]
        n -= len(unzip.decompress(piece, n))
        at += len(piece) - len(unzip.unconsumed_tail)
    return at


def read_member(data: bytes, at: int) -> tuple[list[tuple], int]:
    """Rows of the gzip member at ``at``, and where reading goes on; 0 if the member has content but no record."""
    body, end, damaged = inflate(data, at)
    # Stored blocks that break off take in the bytes of the members after them, so these are looked for too.
    rows = list(read_plain(body) if end else read_archive(body, damaged))
    if not end and rows and rows[-1][0] == "gap":
        rows.pop()  # part of the gap that follows
    if body and not any(r[0] == "record" for r in rows):
        return [], 0
    if not end and rows:
        # Go on at the byte that completed the last record: what inflates after it may belong to other members.
        end = consumed(data, at, max(1, rows[-1][2] - 1)) - 1
    return [(r[0], at, end, r[3], r[4]) for r in rows], end


def read_archive(data: bytes, proven: bool = False):
    """The same over an archive of gzip members and plain records; offsets are of the file, and in a member those of the member."""
    at, bad = 0, None
    zipped = plain = -1
    while at < len(data):
        rows, end = [], 0
        if data.startswith(MEMBER, at):
            rows, end = read_member(data, at)
        elif got := record_at(data, at, proven):
            rows, end = [("record", at, got[2], got[0], got[1])], got[2]
        if end:
            if bad is not None:
                yield "gap", bad, at, None, None
                bad = None
            yield from rows
            at = end
        else:
            bad = at if bad is None else bad
            if zipped <= at:
                zipped = data.find(MEMBER, at + 1) % (len(data) + 1)
            if plain <= at:
                plain = found.start() if (found := VERSION.search(data, at + 1)) else len(data)
            at = min(zipped, plain)
    if bad is not None:
        yield "gap", bad, at, None, None


ROW = "path string, kind string, start long, end long, record_id string, record_type string, uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row for each record, and for each quarantined gap (kind "gap").

    An archive is held whole by Spark's binary reader, so it must be under 2 GB.
    """

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (f.split() for f in ROW.split(", "))])
        for b in batches:
            for where, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows = []
                for kind, start, end, head, block in read_archive(content.as_buffer().to_pybytes()):
                    if kind == "gap":
                        rows.append((where, kind, start, end, *[None] * 7))
                        continue
                    body = payload_of(head, block)
                    revisit = head.get("warc-type") == "revisit"
                    n = int(head["x-payload-length"]) if revisit and head.get("x-payload-length", "").isdecimal() else None if revisit else len(body)
                    digest = head.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else _digest(body)
                    rows.append((where, kind, start, end, head["warc-record-id"], head.get("warc-type"), head.get("warc-target-uri"), head.get("warc-refers-to"), n, digest, body if payloads and not revisit else None))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, ROW)


#: Of the query: before the records of pages whose ids this divides, the archives are damaged.
BROKEN_EVERY = 64


def warc_report(pages: DataFrame) -> DataFrame:
    """Writes the archives, damaged in known places, and reads them back by salvage.

    What is read is written once, records and quarantined gaps alike. It is an error if a record is lost, a damaged place is not
    quarantined, or there is a gap where none was made. (The end of a member that broken bytes swallow may be a gap of its own.)
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path, broken=F.col("page_id") % BROKEN_EVERY == 0)
    rows = written(read_archives(spark, path, payloads=False).drop("payload"), "read")
    made = pages.agg(F.count_if(F.col("page_id") % BROKEN_EVERY == 0), F.count("*")).first()
    found = rows.agg(F.count_if(F.col("kind") == "gap"), F.count_if(F.col("kind") == "record")).first()
    if found[1] != made[1] or found[0] < made[0] or bool(found[0]) != bool(made[0]):
        raise RuntimeError(f"{found[0]} gaps and {found[1]} records were read of {made[0]} and {made[1]}: see {path}")

    def number(c: str) -> Column:
        return F.regexp_extract(c, r"^<urn:x-page:(-?[0-9]+)>$", 1).try_cast(pages.schema["page_id"].dataType)

    return rows.where("kind = 'record'").select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.when(F.col("record_type") == "revisit", number("refers_to")).alias("refers_to"))
